"""URL filters: hierarchical host/path rules by a sort-merge range join.

A rule (host, path) fits its host and all subdomains where the url's path
starts with the rule's path.  Hosts are written with their labels reversed,
each ended by a dot, then ``/`` and the path: a rule is then a prefix of the
keys it fits, i.e. an interval [key, key + U+10FFFF).  A url gives one probe
per suffix of its host (``a.b.org`` -> ``org``, ``b.org``, ``a.b.org``), each
with its whole path, so that rules of every depth meet their subdomains.

Probes and rules are dealt by key range and sorted; one sweep per range keeps
a stack of the rules whose interval is open (nested prefixes), and a probe
takes the open ones.  A rule that spans several ranges is repeated in each of
them; ranges are cut at ranks of a hash sample of (key, page), so that one
address that holds a third of all rows is spread over several ranges too.

The longest rule wins (characters of host + path; ties: longer host, then
host and path order).  Null urls, and urls without ``://``, have empty host
and path and fit no rule.  Null ids and repeated rows stay, one result row
per input row; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.tables import only
from salesmart.llm.textops import freed

END = "\U0010FFFF"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url, both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring({u}, instr({u}, '://') + 3)".format(u="`url`")))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def canonical_key(host: str, path: str) -> str:
    """``www.a.org`` + ``/x`` -> ``org.a.www./x``"""
    return "".join(f"{label}." for label in reversed(host.split("."))) + path


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] | DataFrame, *,
               id_col: str = "page_id", url_col: str = "url", default: str = "allow",
               ranges: int | None = None) -> DataFrame:
    """(id, url, host, path, rule, verdict) for every row of ``pages``.

    ``rules``: (verdict, host, path) rows, or a DataFrame of these columns.
    """
    spark = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(rules, "verdict string, host string, path string")
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = only(pages, id_col, url_col).withColumnRenamed(url_col, "url")
    host, path = host_and_path(F.col("url"))
    base = base.select(F.col(id_col).alias("id"), "url", host.alias("host"), path.alias("path"))

    # A rule of d labels can fit a host at its last d labels only: those depths
    # that some rule has are probed, whatever the host's length.  A probe
    # carries a hash of the url in its place.
    base = base.withColumn("url_hash", F.xxhash64("url"))
    labels = F.reverse(F.split("host", r"\."))
    depths = [r.d for r in rules.where("host is not null").select(
        F.size(F.split("host", r"\.")).alias("d")).distinct().orderBy("d").collect()]
    probes = (
        base.where("host != ''")
        .withColumn("labels", labels)
        .withColumn("depth", F.explode(F.filter(F.array(*[F.lit(d) for d in depths]).cast("array<int>"),
                                                lambda d: d <= F.size("labels"))))
        .select("id", "url_hash", "depth",
                F.concat(F.array_join(F.slice("labels", F.lit(1), F.col("depth")), "."), F.lit("."), "path").alias("key"))
    )
    # Cut points: ranks of the `wanted` smallest hashes, a uniform sample
    # whose size follows the number of ranges, not the rows.
    wanted = 32 * ranges
    tag = F.lpad(F.hex(F.xxhash64("id", "url_hash", "depth")), 16, "0")
    probes = probes.withColumn("tag", tag)
    sample = sorted((r.key, r.tag) for r in probes.select("key", "tag").distinct().orderBy("tag", "key").limit(wanted).collect())
    cuts = [sample[i] for i in range(len(sample) // ranges or 1, len(sample), max(1, len(sample) // ranges))]
    cuts = sorted(set(cuts))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [bisect_right(cuts, kt) for kt in zip(b["key"].to_pylist(), b["tag"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), b["key"], b["tag"], b["id"], b["url_hash"]],
                names=["bucket", "key", "tag", "id", "url_hash"])

    kinds = dict(base.dtypes)
    dealt = probes.mapInArrow(freed(deal), f"bucket int, key string, tag string, id {kinds['id']}, url_hash bigint")

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for v, h, p in zip(pdf["verdict"], pdf["host"], pdf["path"]):
                if v is None or h is None:
                    continue
                key = canonical_key(h, p or "")
                for b in range(bisect_right(cuts, (key, "")), bisect_right(cuts, (key + END, "")) + 1):
                    rows.append((b, key, "", v, h, p or ""))
            yield pd.DataFrame(rows, columns=["bucket", "key", "tag", "verdict", "rhost", "rpath"])

    spread_rules = rules.select("verdict", "host", "path").distinct().mapInPandas(
        spread, "bucket int, key string, tag string, verdict string, rhost string, rpath string")

    both = dealt.unionByName(spread_rules, allowMissingColumns=True)
    # A rule sorts before the probes of an equal key: its tag is empty.
    both = both.repartition(ranges, "bucket").sortWithinPartitions("bucket", "key", "tag")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[tuple[str, str, str, str]] = []
        bucket = None
        for batch in batches:
            at, found = [], []
            columns = ("bucket", "key", "verdict", "rhost", "rpath")
            for i, (b, key, v, h, p) in enumerate(zip(*(batch[c].to_pylist() for c in columns))):
                if b != bucket:
                    bucket, stack = b, []
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if v is not None:
                    stack.append((key, v, h, p))
                elif stack:
                    # Open rules are prefixes of each other: the top is the
                    # longest that fits this probe (two of one key: by verdict).
                    at.append(i)
                    found.append(min((x for x in reversed(stack) if x[0] == stack[-1][0]), key=lambda x: x[1]))
            rows = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [rows["id"], rows["url_hash"], *(pa.array([f[j] for f in found], pa.string()) for j in (2, 3, 1))],
                names=["id", "url_hash", "rhost", "rpath", "verdict"])

    hits = both.mapInArrow(freed(sweep), f"id {kinds['id']}, url_hash bigint, rhost string, rpath string, verdict string")
    length = F.length("rhost") + F.length("rpath")
    best = hits.groupBy(F.col("id").alias("bid"), F.col("url_hash").alias("burl")).agg(
        F.max(F.struct(length.alias("n"), F.length("rhost").alias("h"), "rhost", "rpath", "verdict")).alias("best"))
    return base.join(best, base.id.eqNullSafe(best.bid) & (base.url_hash == best.burl), "left").select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "host", "path",
        F.concat("best.rhost", "best.rpath").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
