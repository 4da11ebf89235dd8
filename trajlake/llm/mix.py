"""Mixing sources to target shares of tokens (problem 8)."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajlake.plans.storage import cut

#: A public tokenizer's ranks (see the tokenizers' README); the rule that cuts text comes with the package beside it.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Hash ranges of a source; only the one range in which a cut lies is ever sorted.
RANGE_BITS = 12
#: Documents from which a range is cut finer.
RANGE_ROWS = 1 << 16
#: Sources that a mix may have; their targets and the sums of their ranges are sent to every task.
SOURCES = 1024


def load_tokenizer(path: str, pattern: str | None = None):
    """A tiktoken encoding without special tokens from a file of ranks."""
    import tiktoken

    if pattern is None:
        from public_tokenizers import PATTERN as pattern
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding(os.path.basename(path), pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


_LOADED: dict[tuple, object] = {}


def _count(path: str, pattern: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if (path, pattern) not in _LOADED:
            _LOADED[path, pattern] = load_tokenizer(path, pattern)
        encode = _LOADED[path, pattern].encode_ordinary
        for b in batches:
            n = [len(encode(t)) if t else 0 for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in ("doc", "source", "key")), pa.array(n, pa.int64())], ["doc", "source", "key", "tokens"])

    return run


def source_name(col: Column) -> Column:
    """A source's name without differences of case, blanks and separators."""
    return F.regexp_replace(F.regexp_replace(F.lower(col), r"[^\p{L}\p{N}]+", "_"), r"^_+|_+$", "")


def mix_sources(documents: DataFrame, targets: DataFrame, *, doc: str = "doc_id", text: str = "text", source: str = "source", tokenizer: str = TOKENIZER, pattern: str | None = None, total_tokens: int | None = None, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(documents of the mix with their number of copies, the shares asked for and reached by each source).

    targets: source, target_share, max_repeats. The mix is as large as it can be while every source that has tokens
    gets its share without any document being taken more than its source's max_repeats times, or `total_tokens` if that
    is given, in which case a source too small falls short and the report says by how much. Shares are relative to
    those of the sources that have tokens; a source without any is reported with 0.

    Documents get a hash-random key by `seed`. A source's budget is spent on whole epochs, then on its documents in
    order of keys as far as they fit: prefix sums over 2**12 hash ranges, more where a range would hold many
    documents, find the range in which the budget ends, and only that range is sorted. So a source may hold any part of all rows. Each source ends less than one document below
    its budget. Null and unnamed sources, those without a target, and documents without id are not in the mix; empty
    texts have no tokens and count nowhere; repeated rows of a document are further documents. More than SOURCES targets
    are an error.
    """
    goal = targets.select(source_name(F.col("source")).alias("source"), F.col("target_share").cast("double").alias("target_share"), F.greatest(F.col("max_repeats"), F.lit(0)).cast("bigint").alias("max_repeats"))
    goal = goal.filter("source is not null and target_share > 0 and max_repeats is not null").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    if goal.limit(SOURCES + 1).count() > SOURCES:
        raise ValueError(f"a mix has at most {SOURCES} sources")
    named = documents.filter(F.col(f"`{doc}`").isNotNull()).select(F.col(f"`{doc}`").alias("doc"), source_name(F.col(f"`{source}`")).alias("source"), F.xxhash64(F.lit(seed), F.col(f"`{doc}`")).alias("key"), F.col(f"`{text}`").alias("text"))
    named = named.join(F.broadcast(goal.select("source")), "source", "left_semi").select("doc", "source", "key", "text")
    kind = documents.schema[doc].dataType.simpleString()
    counted = cut(named.mapInArrow(_count(tokenizer, pattern), f"doc {kind}, source string, key bigint, tokens bigint").filter("tokens > 0"))
    bits = max(RANGE_BITS, (counted.count() // RANGE_ROWS).bit_length())
    ranged = counted.withColumn("range", F.shiftrightunsigned("key", 64 - bits))

    # a row for each source with a target
    have = goal.join(counted.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")), "source", "left").fillna(0, ["tokens", "docs"])
    some = F.col("tokens") > 0
    size = F.lit(float(total_tokens)) if total_tokens is not None else F.min(F.when(some, F.col("tokens") * F.col("max_repeats") / F.col("share"))).over(Window.partitionBy(F.lit(0)))
    have = have.withColumn("share", F.col("target_share") / F.sum(F.when(some, F.col("target_share"))).over(Window.partitionBy(F.lit(0))))
    have = have.withColumn("size", size).withColumn("budget", F.when(some, F.least(F.floor(F.col("share") * F.col("size") + 1e-6), F.col("tokens") * F.col("max_repeats"))).otherwise(0))
    plan = cut(have.withColumn("epochs", F.when(some, F.expr("budget div tokens")).otherwise(0)).withColumn("rest", F.when(some, F.expr("budget % tokens")).otherwise(0)))

    sums = ranged.groupBy("source", "range").agg(F.sum("tokens").alias("n"))
    before = sums.withColumn("before", F.sum("n").over(Window.partitionBy("source").orderBy("range")) - F.col("n")).join(F.broadcast(plan.select("source", "epochs", "rest")), "source")
    # a row for each source with a target: ranges that are taken whole come first, then at most one in which the budget ends
    ends = (F.col("before") < F.col("rest")) & (F.col("before") + F.col("n") > F.col("rest"))
    fate = before.groupBy("source", "epochs").agg(F.max(F.when(F.col("before") + F.col("n") <= F.col("rest"), F.col("range"))).alias("whole"), F.max(F.when(ends, F.struct("range", (F.col("rest") - F.col("before")).alias("left_over")))).alias("edge"))
    placed = ranged.join(F.broadcast(fate), "source").withColumn("left_over", F.col("edge.left_over"))
    placed = placed.withColumn("all", F.when(F.col("range") <= F.col("whole"), 1).when(F.col("range") == F.col("edge.range"), F.lit(None)).otherwise(0)).drop("whole", "edge")
    whole = placed.filter("all is not null").withColumn("copies", F.col("epochs") + F.col("all"))
    upto = F.sum("tokens").over(Window.partitionBy("source", "range").orderBy("key", "doc", "tokens").rowsBetween(Window.unboundedPreceding, 0))
    edge = placed.filter("all is null").withColumn("copies", F.col("epochs") + (upto <= F.col("left_over")).cast("int"))
    chosen = whole.select("doc", "source", "tokens", "copies").unionByName(edge.select("doc", "source", "tokens", "copies")).filter("copies > 0")
    chosen = chosen.select(F.col("doc").alias(doc), "source", "tokens", F.col("copies").cast("int").alias("copies"))

    got = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mix_tokens"), F.count(F.lit(1)).alias("mix_docs"), F.max("copies").alias("most_copies"))
    report = plan.join(got, "source", "left").fillna(0, ["mix_tokens", "mix_docs", "most_copies"])
    report = report.withColumn("actual_share", F.col("mix_tokens") / F.sum("mix_tokens").over(Window.partitionBy(F.lit(0)))).select("source", "target_share", F.col("actual_share"), "max_repeats", "most_copies", F.col("tokens").alias("source_tokens"), F.col("docs").alias("source_docs"), "budget", "mix_tokens", "mix_docs")
    return chosen, report
