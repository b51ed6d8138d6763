"""Text columns: joining title and body, ticker extraction, sentiment tokens. All native expressions."""

from __future__ import annotations

import re
import sys
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# A run of letters, digits and underscores: what a whole-word match means for Unicode text. Written out as classes
# because `\b` and `\w` differ between Java releases; plain letters come first, since asking for a property is slow.
WORD = r"[A-Za-z0-9_[\x{80}-\x{10FFFF}&&[\p{L}\p{N}]]]+"

# Fixed value: a cashtag is a dollar sign and up to five capitals; nothing is asked of the character after it.
CASHTAG = r"\$([A-Z]{1,5})"
_PLAIN_SYMBOL = re.compile(r"[A-Z]{1,5}")

# Letters whose capital form has more than one character. A whole-word match compares character by character, so these
# match nothing, and must not turn into a ticker when upper-cased: a letter that is its own capital takes their place. That
# is a table look-up for each character; a class of a pattern would try letter after letter.
WIDE_LETTERS = "".join(c for c in map(chr, range(0x80, sys.maxunicode + 1)) if len(c.upper()) > 1)
OWN_CAPITALS = "ẞ" * len(WIDE_LETTERS)
WIDENING = f"[{WIDE_LETTERS}]"

# White space as Unicode defines it, and the separator controls that Python's str.split() adds. Asking for the property
# is twice as fast as listing the characters.
SPACE = r"[\p{IsWhite_Space}\x1C-\x1F]+"

# Fixed value: the ASCII punctuation marks.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _texts(values: Sequence[str]) -> Column:
    if not values:
        return F.array().cast("array<string>")
    return F.array(*[F.lit(value) for value in values])


def full_text(title: Column | str, text: Column | str) -> Column:
    """Title and body on two lines; a missing one is left out and the result is never null."""
    return F.concat_ws("\n", _col(title), _col(text))


def word_symbols(watchlist: Sequence[str]) -> list[str]:
    """The watch list in capitals. Symbols must be single words, or a whole-word match could not find them."""
    symbols = sorted({symbol.upper() for symbol in watchlist})
    odd = [symbol for symbol in symbols if not re.fullmatch(r"\w+", symbol)]
    if odd:
        raise ValueError(f"symbols must be made of letters, digits and underscores: {odd}")
    return symbols


def plain_symbols(watchlist: Sequence[str]) -> list[str]:
    """The watch list for the strict patterns, which can only find symbols of up to five capitals."""
    odd = sorted({symbol for symbol in watchlist if not _PLAIN_SYMBOL.fullmatch(symbol)})
    if odd:
        raise ValueError(f"symbols must be one to five capitals, or no strict pattern finds them: {odd}")
    return sorted(set(watchlist))


def extract_tickers(text: Column | str, watchlist: Sequence[str]) -> Column:
    """Watch-listed symbols that occur in `text` as whole words in any case: distinct, upper-case, sorted.

    One pass over the characters cuts the text into words; a hash intersection with the watch list follows. Cost does
    not grow with the length of the watch list, as an alternation of all symbols would.
    """
    symbols = word_symbols(watchlist)
    text = _col(text)
    plain = F.when(F.octet_length(text) == F.length(text), text).otherwise(F.translate(text, WIDE_LETTERS, OWN_CAPITALS))
    words = F.regexp_extract_all(F.upper(plain), F.lit(WORD), F.lit(0))
    return F.coalesce(F.sort_array(F.array_intersect(words, _texts(symbols))), _texts([]))


def extract_cashtags(text: Column | str, watchlist: Sequence[str]) -> Column:
    """The strict variant: `$ABC` or a whole word in capitals, at most five letters, case-sensitive; sorted."""
    symbols = plain_symbols(watchlist)
    text = _col(text)
    found = F.concat(
        F.regexp_extract_all(text, F.lit(CASHTAG), F.lit(1)),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
    )
    return F.coalesce(F.sort_array(F.array_intersect(found, _texts(symbols))), _texts([]))


def tokens(text: Column | str) -> Column:
    """The white-space separated pieces of `text`, in lower case; punctuation still attached."""
    return F.split(F.lower(_col(text)), SPACE)


def lexicon_term(token: Column | str) -> Column:
    """What to look up for a token: without punctuation at its ends, unless too little would be left (`:-)`)."""
    token = _col(token)
    bare = F.btrim(token, F.lit(PUNCTUATION))
    # Most tokens start and end with a plain letter and need no trimming, which is slow.
    plain = F.substring(token, 1, 1).between("a", "z") & F.substring(token, -1, 1).between("a", "z")
    return F.when(plain | (F.length(bare) <= 2), token).otherwise(bare)
