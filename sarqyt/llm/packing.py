"""Problem 8: filling containers of a fixed number of tokens, by hierarchical residual packing.

Each text is measured in tokens of a public tokenizer (its file is a parameter). Texts larger than a container are cut:
full containers first, the rest is an item like any other. Items are packed best-fit, largest first, in each partition;
containers that are nearly full leave. The others become items themselves (a container's contents move as one) and are
packed again in a tree of fewer and fewer partitions, each of at most ``TASK_ITEMS`` items, until one partition is left
or two rounds on, dealt anew each time, nothing has merged any more.

What moves between rounds is numbers (id, piece, tokens), never text, and the contents of one container, which its
capacity bounds. Rounds are checkpointed. The result is the same whatever happens to executors and however the files
are laid out: items are named by what they are, partitioning is by hash of the name and the round, and order within a
partition by size and name.

Defined results: null and empty texts have no tokens but are items of size 0, packed like others at the cost of one token;
a text of exactly the capacity fills a container; rows with the same id are items of their own.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sarqyt.session import cut, spread

CAPACITY = 2048
# Fixed value: the public pre-tokenisation pattern of byte-level BPE
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
NEARLY_FULL = 0.98
TASK_ITEMS = 200_000
SHRINK = 8
EQUAL = 10_000

MEMBERS = pa.list_(pa.struct([("id", pa.int64()), ("piece", pa.int32()), ("tokens", pa.int32())]))
BINS = pa.schema([("bin", pa.string()), ("size", pa.int32()), ("members", MEMBERS)])
DDL = "bin string, size int, members array<struct<id:bigint,piece:int,tokens:int>>"


def counter(path: str):
    """Counts tokens with a rank file (.tiktoken), a tokenizers file (.json) or a sentencepiece model (.model)."""
    if path.endswith(".tiktoken"):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in Path(path).read_bytes().splitlines() if line)}
        enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [len(x) for x in enc.encode_ordinary_batch(texts, num_threads=1)]
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        return lambda texts: [len(x.ids) for x in t.encode_batch(texts, add_special_tokens=False)]
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]


def sizes(df: DataFrame, key: str, text: str = "text", *, tokenizer: str) -> DataFrame:
    """``(id, tokens)`` of every row. The tokenizer's file is sent along with the job."""
    df.sparkSession.sparkContext.addFile(tokenizer)
    name = Path(tokenizer).name

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(SparkFiles.get(name))
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            out: list[int] = []
            for i in range(0, len(texts), 500):
                out += count(texts[i : i + 500])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.int32())], ["id", "tokens"])

    return spread(df.select(F.col(key).cast("bigint").alias(key), text), key).mapInArrow(go, "id bigint, tokens int")


def best_fit(items: list[tuple[int, str]], capacity: int) -> list[list[int]]:
    """Best fit, largest item first: for (size, name) items, the indexes of each container's items."""
    order = sorted(range(len(items)), key=lambda i: (-items[i][0], items[i][1]))
    free: list[tuple[int, int]] = []  # (space left, container), sorted
    out: list[list[int]] = []
    for i in order:
        size = max(1, items[i][0])
        at = bisect_left(free, (size, -1))
        if at < len(free):
            left, c = free.pop(at)
            out[c].append(i)
        else:
            left, c = capacity, len(out)
            out.append([i])
        if left > size:
            insort(free, (left - size, c))
    return out


def _pack(bins: DataFrame, capacity: int) -> DataFrame:
    """One round: every partition's bins merged by best fit."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for b in batches for r in b.to_pylist()]
        made = []
        for group in best_fit([(r["size"], r["bin"]) for r in rows], capacity):
            members = [m for i in group for m in rows[i]["members"]]
            made.append({"bin": min(rows[i]["bin"] for i in group), "size": sum(max(1, rows[i]["size"]) for i in group), "members": members})
        for i in range(0, len(made), 5000):
            yield pa.RecordBatch.from_pylist(made[i : i + 5000], BINS)

    return bins.mapInArrow(go, DDL)


def _items(item: DataFrame, capacity: int) -> DataFrame:
    """The pieces of (id, tokens) as containers of one item each, by the name (id, tokens, which of the equal ones, piece)."""
    # equal rows are told apart by number; thousands of them at a time, so that a hot one makes no giant row
    equal = item.groupBy("id", "tokens").agg(F.count(F.lit(1)).alias("n"))
    equal = equal.select("id", "tokens", "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / EQUAL))).alias("k"))
    equal = equal.select("id", "tokens", F.explode(F.sequence(F.col("k") * EQUAL, F.least(F.col("n"), (F.col("k") + 1) * EQUAL) - 1)).alias("nth"))
    whole = F.floor(F.greatest(F.col("tokens") - 1, F.lit(0)) / capacity).cast("int")
    piece = F.explode(F.transform(F.sequence(F.lit(0), whole), lambda i: F.struct(i.cast("int").alias("piece"), F.least(F.lit(capacity), F.col("tokens") - i * capacity).cast("int").alias("tokens"))))
    name = F.concat(F.when(F.col("id").isNull(), "none").otherwise(F.format_string("%020d", "id")), F.format_string("-%d-%d-%06d", "tokens", "nth", "p.piece"))
    return equal.select("id", "tokens", "nth", piece.alias("p")).select(name.alias("bin"), F.col("p.tokens").alias("size"), F.array(F.struct("id", F.col("p.piece").alias("piece"), F.col("p.tokens").alias("tokens"))).alias("members"))


def containers(df: DataFrame, key: str, text: str = "text", *, tokenizer: str, capacity: int = CAPACITY, nearly_full: float = NEARLY_FULL, task_items: int = TASK_ITEMS) -> DataFrame:
    """``(key, piece, tokens, container)``: the container of every row, by piece where a row is larger than one."""
    bins = cut(_items(sizes(df, key, text, tokenizer=tokenizer), capacity))
    cores = df.sparkSession.sparkContext.defaultParallelism
    left, full, idle, turn = bins.count(), [], 0, 0
    parts = max(cores, -(-left // task_items))
    closed = F.col("size") >= capacity * nearly_full
    while left:
        # the round is part of the hash, so bins that were together part and meet others
        turn += 1
        packed = cut(_pack(bins.repartition(parts, F.xxhash64("bin", F.lit(turn))), capacity))
        now = packed.where(~closed).count()
        idle = idle + 1 if now == left else 0
        if parts == 1 or idle == 2:
            full.append(packed)
            break
        full.append(packed.where(closed))
        bins, left = packed.where(~closed), now
        parts = max(1, min(parts // SHRINK, parts - 1), -(-left // task_items))
    if not full:
        full = [bins]
    out = full[0]
    for f in full[1:]:
        out = out.unionByName(f)
    return out.select(F.col("bin").alias("container"), F.explode("members").alias("m")).select(F.col("m.id").alias(key), F.col("m.piece").alias("piece"), F.col("m.tokens").alias("tokens"), "container")


def fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: containers, items, tokens, and the share of the containers' space that is used."""
    per = packed.groupBy("container").agg(F.count(F.lit(1)).alias("items"), F.sum("tokens").alias("tokens"))
    return per.agg(F.count(F.lit(1)).alias("containers"), F.sum("items").alias("items"), F.sum("tokens").alias("tokens"), F.max("tokens").alias("largest"), F.try_divide(F.sum("tokens"), F.count(F.lit(1)) * capacity).alias("filled"))
