"""Weak supervision of text quality: rules vote or abstain, and expectation-maximisation learns how far to trust each.

Every rule votes good (1), bad (-1) or abstains (0) on a document. Documents are counted by their votes, at most three
to the power of the number of rules rows, however large the corpus. On these counts EM estimates the share of good
documents and each rule's accuracy where it votes, on good and on bad documents apart (Dawid and Skene, 1979): most rules
find hardly anything to object to, so their good votes say little and a bad vote says much. A document is kept if its
posterior probability of being good reaches the threshold, whether or not some single rule objects.

All of it is Spark SQL functions: counting, the EM steps (a fold over iterations in one row) and the posterior.

Null and empty texts have no words: all counts are 0 and they fail the base rule. An empty table gives no row, and EM is
left at its start values.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from marketpulse.llm.common import BLANKS, bind, settle, words_of

WINDOW_WORDS = 8
ITERATIONS = 25
START_ACCURACY, START_SHARE = 0.75, 0.75
# The start values weigh as much as this share of all documents, so nothing is ever taken as certain, at any size.
PRIOR = 0.02
THRESHOLD = 0.5
SYMBOLS = "#*$%&|<>"
# A word's last character, where that is of ASCII and no letter.
ODD_END = r"[\x00-\x08\x0E-\x1F\x21-\x40\x5B-\x60\x7B-\x7F](?=[\x20\x09-\x0D]|\z)"


def repeated_words(words: Column, span: int = WINDOW_WORDS) -> Column:
    """Words that stand in a window of `span` words found twice or more in the array, the first find included.

    Windows are told apart by 64-bit hashes inside one text. Most texts repeat no window, and for them the hashes are
    only counted; the others sort (hash, position) and add up what the repeated windows cover.
    """
    def of_windows(windows: Column) -> Column:
        placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))

        def covered(found: Column) -> Column:
            twice = F.transform(found, lambda x, i: F.when(
                F.coalesce(x["h"] == F.get(found, i - 1)["h"], F.lit(False))
                | F.coalesce(x["h"] == F.get(found, i + 1)["h"], F.lit(False)),
                x["at"],
            ))
            start = F.struct(F.lit(-span).alias("last"), F.lit(0).alias("n"))
            return F.aggregate(
                F.array_sort(F.array_compact(twice)), start,
                lambda s, at: F.struct(at.alias("last"), (s["n"] + F.least(at - s["last"], F.lit(span))).alias("n")),
            )["n"]

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(bind(placed, covered))

    def of_hashes(hashes: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(1), F.size(hashes) - (span - 1)), lambda i: F.xxhash64(F.slice(hashes, i, F.lit(span)))
        )
        return F.when(F.size(hashes) < span + 1, F.lit(0)).otherwise(bind(windows, of_windows))

    return bind(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def metrics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document, whole texts, no shuffle.

    Columns: key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_marks, n_capitals, n_distinct (different
    words), n_ends (words whose last character is a letter of ASCII or no character of it), n_short (words of at most three
    characters).
    """
    content = F.coalesce(F.col(text), F.lit(""))

    def without(characters: str) -> Column:
        return (F.length(content) - F.length(F.translate(content, characters, ""))).cast("bigint")

    lines = F.filter(F.split(content, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    counts = bind(words_of(text), lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"), repeated_words(w).cast("bigint").alias("n_repeat_words"),
        F.size(F.array_distinct(w)).cast("bigint").alias("n_distinct"),
        F.size(F.filter(w, lambda x: F.length(x) <= 3)).cast("bigint").alias("n_short"),
    ))
    return docs.select(
        key, counts.alias("_c"),
        F.length(F.regexp_replace(content, BLANKS, "")).cast("bigint").alias("word_chars"),
        without(SYMBOLS).alias("n_symbols"),
        bind(lines, lambda l: F.size(l) - F.size(F.array_distinct(l))).cast("bigint").alias("n_dup_lines"),
        without("!?").alias("n_marks"),
        without("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_capitals"),
        F.regexp_count(content, F.lit(ODD_END)).alias("_odd"),
    ).select(
        key, "_c.n_words", "word_chars", "n_symbols", "n_dup_lines", "_c.n_repeat_words", "n_marks", "n_capitals",
        "_c.n_distinct", (F.col("_c.n_words") - F.col("_odd")).alias("n_ends"), "_c.n_short",
    )


def vote(good: str, bad: str) -> Column:
    return F.expr(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END")


# name: (votes good if, votes bad if), in whole numbers of the metrics' columns.
RULES: Mapping[str, tuple[str, str]] = {
    "enough words": ("n_words >= 40", "n_words < 20"),
    "little repetition": ("100 * n_repeat_words <= 10 * n_words", "100 * n_repeat_words > 30 * n_words"),
    "few symbols": ("100 * n_symbols <= 2 * n_words", "100 * n_symbols > 20 * n_words"),
    "few equal lines": ("n_dup_lines = 0", "n_dup_lines >= 4 AND 15 * n_dup_lines > n_words"),
    "usual words": (
        "10 * word_chars >= 35 * n_words AND 10 * word_chars <= 65 * n_words",
        "10 * word_chars < 25 * n_words OR 10 * word_chars > 75 * n_words",
    ),
    "words end in letters": ("100 * n_ends >= 75 * n_words", "100 * n_ends < 60 * n_words"),
    "some short words": (
        "100 * n_short >= 22 * n_words AND 100 * n_short <= 45 * n_words", "100 * n_short < 12 * n_words OR 100 * n_short > 60 * n_words"
    ),
    "different words": ("100 * n_distinct >= 50 * n_words", "100 * n_distinct < 20 * n_words"),
    "few marks": ("50 * n_marks <= n_words", "5 * n_marks > n_words"),
    "few capitals": ("100 * n_capitals <= 10 * word_chars", "100 * n_capitals > 40 * word_chars"),
}


def votes(measured: DataFrame, rules: Mapping[str, tuple[str, str]] = RULES) -> Column:
    return F.array(*[vote(good, bad) for good, bad in rules.values()])


def log_odds(p: Column) -> Column:
    return F.log(p / (F.lit(1.0) - p))


def posterior(ballot: Column, share: Column, on_good: Column, on_bad: Column) -> Column:
    """Probability of good: each vote adds the logarithm of how much likelier it is on a good than on a bad document.

    `on_good` and `on_bad` hold each rule's accuracy on documents of that kind; an abstention adds nothing.
    """
    one = F.lit(1.0)
    ratios = F.zip_with(on_good, on_bad, lambda g, b: F.struct(F.log(g / (one - b)).alias("good"), F.log((one - g) / b).alias("bad")))
    weighted = F.zip_with(ballot, ratios, lambda v, r: F.when(v == 1, r["good"]).when(v == -1, r["bad"]).otherwise(F.lit(0.0)))
    evidence = F.aggregate(weighted, log_odds(share), lambda s, x: s + x)
    return one / (one + F.exp(-evidence))


def estimate(ballots: DataFrame, n_rules: int, iterations: int = ITERATIONS) -> DataFrame:
    """One row (share, accuracies, on_good, on_bad) from (ballot, n): EM as a fold over its iterations.

    A step weighs every pattern of votes with its posterior; the share is the mean posterior, and a rule's accuracy the
    mean probability of being right where it votes, on good and on bad documents; `accuracies` is that of both together.
    Start values are mixed in with the weight PRIOR, and a rule that never votes keeps them.
    """
    rows = ballots.agg(F.array_sort(F.collect_list(F.struct("ballot", F.col("n").cast("double").alias("n")))).alias("rows"))
    rules = F.sequence(F.lit(0), F.lit(n_rules - 1))
    same = F.array(*[F.lit(START_ACCURACY)] * n_rules)
    start = F.struct(F.lit(START_SHARE).alias("share"), same.alias("on_good"), same.alias("on_bad"))

    def total(array: Column, value) -> Column:
        return F.aggregate(array, F.lit(0.0), lambda s, x: s + value(x))

    def weigh(state: Column) -> Column:
        return F.transform("rows", lambda r: F.struct(
            r["ballot"].alias("ballot"), r["n"].alias("n"),
            (r["n"] * posterior(r["ballot"], state["share"], state["on_good"], state["on_bad"])).alias("good"),
        ))

    def mixed(found: Column, right: Column, cast: Column, first: float) -> Column:
        prior = F.lit(PRIOR) * total(found, lambda r: r["n"])
        return (right + prior * F.lit(first)) / (cast + prior)

    def accuracy(found: Column, j: Column, vote: int, weight) -> Column:
        def where(r: Column, condition: Column) -> Column:
            return F.when(condition, weight(r)).otherwise(F.lit(0.0))

        right = total(found, lambda r: where(r, F.get(r["ballot"], j) == vote))
        return mixed(found, right, total(found, lambda r: where(r, F.get(r["ballot"], j) != 0)), START_ACCURACY)

    def step(state: Column, _: Column) -> Column:
        return bind(weigh(state), lambda found: F.struct(
            mixed(found, total(found, lambda r: r["good"]), total(found, lambda r: r["n"]), START_SHARE).alias("share"),
            F.transform(rules, lambda j: accuracy(found, j, 1, lambda r: r["good"])).alias("on_good"),
            F.transform(rules, lambda j: accuracy(found, j, -1, lambda r: r["n"] - r["good"])).alias("on_bad"),
        ))

    known = F.aggregate(F.sequence(F.lit(1), F.lit(iterations)), start, step)
    learned = rows.select(F.when(F.size("rows") > 0, known).otherwise(start).alias("e")).select("e.*")
    together = F.zip_with("on_good", "on_bad", lambda g, b: F.col("share") * g + (F.lit(1.0) - F.col("share")) * b)
    return learned.select("share", together.alias("accuracies"), "on_good", "on_bad")


def judge(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Mapping[str, tuple[str, str]] = RULES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The metrics of every document with base_failed, quality (the posterior) and kept.

    The metrics are written once, a few numbers for each document, since both the counts of votes and the result need
    them. One shuffle, of vote patterns that are counted before it.
    """
    measured = settle(metrics(docs, key, text).withColumn("ballot", votes(docs, rules)))
    learned = estimate(measured.groupBy("ballot").agg(F.count("*").alias("n")), len(rules)).first()
    quality = posterior(
        F.col("ballot"), F.lit(learned["share"]), F.array(*map(F.lit, learned["on_good"])), F.array(*map(F.lit, learned["on_bad"]))
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return measured.withColumns({"base_failed": failed, "quality": quality}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= threshold)
    )
