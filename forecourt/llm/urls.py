"""URL filter: host and path rules, then a ratio of character models (operator 8).

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import cut_lineage

# (host and path, verdict)
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
CALIBRATION_FOLDS = 5
KEPT_SHARE = 0.95
BACKOFF = 4.0  # pseudo-counts that the shorter context contributes
SCALE = 1_000_000  # log-likelihood differences are summed as whole millionths
ALPHABET = 49  # characters that _trigrams can make
URLS_PER_TASK = 20_000
MOST_TASKS = 20_000
RATIO_STEP = 100  # a ratio counts ten-thousandths
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII lower case."""
    rest = _after_scheme(url)
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def matching_rule(
    host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES
) -> tuple[Column, Column]:
    """The longest rule that fits host (or a parent domain) and path start, and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, decision in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, slash, start = text.partition("/")
        fits = (host == domain) | host.endswith(f".{domain}")
        fits = fits & path.startswith(slash + start)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def _normal(url: Column) -> Column:
    """The url over a small alphabet: digits become 0, rare and non-ASCII characters ``~``."""
    lower = F.translate(F.coalesce(url, F.lit("")), _UPPER, _UPPER.lower())
    digits = F.translate(lower, "123456789", "0" * 9)
    return F.regexp_replace(digits, r"[^a-z0:/.?#&=%_+\-,;@!$'()*]", "~")


def _with_trigrams(urls: DataFrame, url: str) -> DataFrame:
    """A row for every character of each url, ``gram`` being it with the two before it.

    The start is marked, and so is the end. The url is cut into characters once,
    so a very long one costs time in proportion to its length.
    """
    marked = F.concat(F.lit("^^"), _normal(F.col(url)), F.lit("|"))
    cut = urls.withColumns({"__chars": F.split(marked, ""), "__n": F.length(marked)})
    grams = F.transform(
        F.sequence(F.lit(0), F.col("__n") - 3),
        lambda i: F.concat(*(F.get("__chars", i + k) for k in range(3))),
    )
    return cut.select(*urls.columns, F.explode(grams).alias("gram"))


def _dealt(urls: DataFrame) -> DataFrame:
    """Urls dealt by hash to a number of tasks that follows their number.

    The written table is small beside the rows its characters become, and may be
    a single file; the number is given, so adaptive execution keeps it.
    """
    cores = urls.sparkSession.sparkContext.defaultParallelism
    tasks = min(max(cores, -(-urls.count() // URLS_PER_TASK)), MOST_TASKS)
    return urls.repartition(tasks, "url")


def _log_probabilities(grams: DataFrame, counted: Column, label: str) -> DataFrame:
    """``gram`` with ln p(character | context) as ``label``, from trigram counts.

    The context is as long as the counts support: each longer context adds its
    counts to ``BACKOFF`` pseudo-counts dealt by the next shorter one, down to an
    even distribution over the alphabet. ``grams`` is bounded by the alphabet.
    """
    rows = grams.select("gram", counted.alias("n"))
    last, middle = F.substr("gram", F.lit(3)), F.substr("gram", F.lit(2))
    one, two = F.substr("gram", F.lit(2), F.lit(1)), F.substr("gram", F.lit(1), F.lit(2))

    def total(*keys: Column) -> Column:
        return F.sum("n").over(Window.partitionBy(*keys))

    lowest = (total(last) + F.lit(BACKOFF / ALPHABET)) / (
        F.sum("n").over(Window.partitionBy()) + F.lit(BACKOFF)
    )
    shorter = (total(middle) + F.lit(BACKOFF) * lowest) / (total(one) + F.lit(BACKOFF))
    longest = (F.col("n") + F.lit(BACKOFF) * shorter) / (total(two) + F.lit(BACKOFF))
    return rows.select("gram", F.ln(longest).alias(label))


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    kept_share: float = KEPT_SHARE,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, ratio`` of every row of ``pages``.

    The rules decide where one fits. Elsewhere two character models do, learned
    from the urls that rules accept and reject: ``ratio`` is the difference of
    their log-likelihoods divided by the characters, in ten-thousandths, and a url is
    allowed if it reaches the value that ``kept_share`` of the accepted urls
    reach which were held back from learning (a fifth, by a hash of the url).

    A null url is an empty text. A url without ``://`` has an empty host and path
    and is judged by the models. If rules accept or reject nothing, there is no
    ratio to learn and all other urls are allowed. Repeated rows each get a row.

    The table of character triples is bounded by the cube of the alphabet
    (117,649 rows) and so is what the broadcast joins send.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
    ).select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    digest = F.md5(F.coalesce("url", F.lit("")).cast("binary"))
    fold = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % CALIBRATION_FOLDS
    urls = (
        rows.select(
            F.coalesce("url", F.lit("")).alias("url"), verdict.alias("label"), fold.alias("fold")
        )
        .groupBy("url", "label", "fold")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    urls = _dealt(cut_lineage(urls))
    learning = (F.col("fold") != 0) & F.col("label").isNotNull()
    grams = (
        _with_trigrams(urls, "url")
        .groupBy("gram")
        .agg(
            F.sum(F.when(learning & (F.col("label") == "allow"), F.col("n")).otherwise(0)).alias(
                "allowed"
            ),
            F.sum(F.when(learning & (F.col("label") == "block"), F.col("n")).otherwise(0)).alias(
                "blocked"
            ),
        )
    )
    grams = cut_lineage(grams)
    seen = grams.agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked")).first()
    learned = bool(seen["allowed"]) and bool(seen["blocked"])
    good = _log_probabilities(grams, F.col("allowed"), "good")
    bad = _log_probabilities(grams, F.col("blocked"), "bad")
    weight = F.round((F.col("good") - F.col("bad")) * SCALE) if learned else F.lit(0)
    weights = cut_lineage(
        good.join(bad, "gram").select("gram", weight.cast("bigint").alias("weight"))
    )
    scores = cut_lineage(
        _with_trigrams(urls.select(F.col("url").alias("key")).distinct(), "key")
        .join(F.broadcast(weights), "gram")
        .groupBy("key")
        .agg(
            F.floor(F.sum("weight") / (F.count(F.lit(1)) * RATIO_STEP)).alias("ratio"),
        )
    )
    labelled = urls.filter((F.col("label") == "allow") & (F.col("fold") == 0))
    least = _least_kept(labelled.join(scores, F.col("url") == F.col("key")), kept_share)
    by_model = F.when(F.col("ratio") >= least, "allow").otherwise("block")
    return rows.join(scores, F.coalesce("url", F.lit("")) == F.col("key")).select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, by_model if learned else F.lit("allow")).alias("verdict"),
        "ratio",
    )


def _least_kept(scored: DataFrame, kept_share: float) -> int:
    """The least ratio that ``kept_share`` of the urls reach; one row per step of the ratio."""
    counts = scored.groupBy("ratio").agg(F.sum("n").alias("n"))
    up_to = F.sum("n").over(
        Window.orderBy("ratio").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    total = F.sum("n").over(Window.partitionBy())
    passed = counts.select("ratio", (up_to > total * F.lit(1 - kept_share)).alias("enough"))
    found = passed.filter("enough").agg(F.min("ratio").alias("least")).first()["least"]
    return 0 if found is None else int(found)
