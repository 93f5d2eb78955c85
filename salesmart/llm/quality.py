"""Quality rules with DataFrame functions only (no Python on executors).

Besides fixed rules over words and lines, every document is scored by the
log-likelihood ratio of its hashed 1- and 2-grams under two multinomials: a
trusted target (documents labelled good) and the raw corpus (all documents),
divided by the number of its n-grams.  A document is kept if the rules hold
and the score reaches a threshold fitted on labelled rows.

Bounds: ``buckets`` hash buckets, so the driver receives that many counts; the
target and the threshold are fitted on at most ``max_labelled`` labelled rows
of each class (those with the smallest hash of their id).  The raw counts
cover all documents.

Null and empty texts have no words and fail the rules.  Null ids match no
label; repeated rows and ties give one result row each.  Without labels, or
without a labelled document of a class, the score rejects nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.tables import free_name, only

SPACE = r"[ \x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
GRAM = 5


def words(text: Column) -> Column:
    """Words of a text, none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def symbol_count(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")


def repeated_lines(text: Column) -> Column:
    r"""Lines with a word that equal an earlier line of the text."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^ \x09-\x0D]"))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def repeated_words(grams: str) -> Column:
    """Words inside 5-word windows that occur twice or more in the text.

    ``grams`` holds a hash per window.  Mostly all are distinct and nothing
    more is done; else the windows' places are sorted by hash, the places of
    shared hashes sorted again, and the union of their ranges measured.
    """
    placed = f"array_sort(transform({grams}, (h, i) -> named_struct('h', h, 'i', i)))"
    return F.expr(f"""
      case when size({grams}) = size(array_distinct({grams})) then 0L else
        aggregate(
          array(named_struct('p', {placed})), 0L, (acc, s) -> acc + aggregate(
            array_sort(transform(filter(
              transform(s.p, (x, k) -> named_struct('i', x.i, 'twice',
                (k > 0 and s.p[k - 1].h = x.h) or (k + 1 < size(s.p) and s.p[k + 1].h = x.h))),
              x -> x.twice), x -> x.i)),
            named_struct('n', 0L, 'end', 0),
            (a, i) -> named_struct('n', a.n + i + {GRAM} - greatest(i, a.end), 'end', i + {GRAM}),
            a -> a.n))
      end""")


def with_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the words and their hashes (w, wh, grams) and the rule columns."""
    t = F.col(text_col)
    return (
        docs.withColumn("w", words(t))
        .withColumn("n_words", F.size("w").cast("long"))
        .withColumn("word_chars", F.length(F.regexp_replace(F.coalesce(t, F.lit("")), SPACE, "")).cast("long"))
        .withColumn("n_symbols", symbol_count(t))
        .withColumn("n_dup_lines", repeated_lines(t))
        .withColumn("wh", F.expr("transform(w, x -> xxhash64(x))"))
        .withColumn("grams", F.expr(
            f"case when size(wh) < {GRAM} then array() else transform(sequence(0, size(wh) - {GRAM}), "
            f"i -> xxhash64({', '.join(f'wh[i + {j}]' for j in range(GRAM))})) end"))
        .withColumn("n_repeat_words", repeated_words("grams"))
        .withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words"))
    )


def with_features(docs: DataFrame, buckets: int) -> DataFrame:
    """Adds ``feats``: buckets of all words and all pairs of neighbours."""
    return docs.withColumn("feats", F.expr(f"""
        concat(transform(wh, x -> cast(pmod(x, {buckets}) as int)),
               case when size(wh) < 2 then array() else transform(sequence(0, size(wh) - 2),
                 i -> cast(pmod(xxhash64(wh[i], wh[i + 1]), {buckets}) as int)) end)"""))


def labelled_sample(labels: DataFrame, max_labelled: int, id_col: str, good_col: str) -> DataFrame:
    """(sample_id, good): at most ``max_labelled`` labelled rows of each class,
    those with the smallest hash of their id."""
    rows = labels.select(F.col(f"`{id_col}`").alias("sample_id"), F.col(f"`{good_col}`").cast("int").alias("good")) \
        .where("sample_id is not null and good in (0, 1)").groupBy("sample_id").agg(F.min("good").alias("good"))
    order = [F.xxhash64("sample_id"), F.col("sample_id")]
    return rows.where("good = 1").orderBy(*order).limit(max_labelled).union(
        rows.where("good = 0").orderBy(*order).limit(max_labelled))


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
        good_col: str = "quality", buckets: int = 1 << 13, max_labelled: int = 20_000,
        keep_good: float = 0.998) -> tuple[list[float], float]:
    """(weight of each bucket, threshold).

    Raw counts come from every document; the target's from the sample.  The
    threshold is the score that ``keep_good`` of the sample's good documents
    reach, or lower if all bad ones score lower still (halfway then).
    """
    sample = labelled_sample(labels, max_labelled, id_col, good_col)
    base = only(docs, id_col, text_col).withColumnRenamed(text_col, "text")
    tagged = base.join(F.broadcast(sample), F.col(id_col) == F.col("sample_id"), "left")
    hashed = with_features(tagged.select("good", F.transform(words(F.col("text")), lambda x: F.xxhash64(x)).alias("wh")), buckets)
    # The outer form: plain explode would infer a filter on the array's size,
    # which is pushed below and computes the words once more per element.
    grams = hashed.select("good", F.explode_outer("feats").alias("bucket")).where("bucket is not null")
    counts = grams.groupBy("bucket").agg(
        F.count("*").alias("raw"), F.count_if(F.col("good") == 1).alias("target")).collect()
    raw, target = [0.5] * buckets, [0.5] * buckets
    for r in counts:
        raw[r.bucket] += r.raw
        target[r.bucket] += r.target
    if sum(target) <= 0.5 * buckets:
        return [0.0] * buckets, -math.inf
    n, m = sum(raw), sum(target)
    weights = [math.log(t / m) - math.log(x / n) for t, x in zip(target, raw)]
    scored = score(base.join(F.broadcast(sample), F.col(id_col) == F.col("sample_id")), weights).select("good", "score")
    got = {r.good: (r.low, r.top) for r in scored.groupBy("good").agg(
        F.percentile("score", F.lit(1 - keep_good)).alias("low"), F.max("score").alias("top")).collect()}
    if any(None in got.get(k, (None,)) for k in (0, 1)):
        return weights, -math.inf
    low, top = got[1][0], got[0][1]
    return weights, (low + top) / 2 if top < low else low


def score(docs: DataFrame, weights: list[float], text: str = "text") -> DataFrame:
    """Adds ``score``: mean weight of the document's n-grams, null without any."""
    if "wh" not in docs.columns:
        docs = docs.withColumn("wh", F.transform(words(F.col(text)), lambda x: F.xxhash64(x)))
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")  # folded to a literal
    docs = with_features(docs, len(weights)).withColumn("weights", table)
    return docs.withColumn("score", F.expr(
        "case when size(feats) > 0 then aggregate(feats, 0D, (a, b) -> a + weights[b]) / size(feats) end"
    )).drop("weights", "feats", "wh")


def quality_rules(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  good_col: str = "quality", **fitting) -> DataFrame:
    """All columns of ``docs`` plus a struct ``rules`` with n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score,
    kept (named ``rules_`` where the input has a column ``rules``)."""
    weights, threshold = fit(docs, labels, id_col=id_col, text_col=text_col, good_col=good_col, **fitting)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "score", "kept"]
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"))
    judged = score(with_rules(whole).drop("w", "grams"), weights)
    judged = judged.withColumn("kept", F.expr("not base_failed") & F.coalesce(F.col("score") >= F.lit(threshold), F.lit(False)))
    return judged.select("row.*", F.struct(*names).alias(free_name(docs, "rules")))
