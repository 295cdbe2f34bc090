"""Mixing sources to target weights, measured in tokens of a public tokenizer.

1. Every record's tokens are counted once (tiktoken on the rank file; the path is a parameter). Source labels that differ in case or signs are one.
2. A source's records are split into blocks by a seeded hash, as many as its tokens make of BLOCK_TOKENS each, so a hot source has many blocks and no block is
   large. Blocks' sizes (numbers, one per block of a wanted source) come to the driver. The total is the largest at which every source present has its share with no record used more than max_repeats times; shares
   of sources without records are left out of it and reported. A given total beyond that leaves scarce sources at their cap and reports what they lack.
3. A source's quota is whole passes over its blocks and then a part of one, in a permuted order; the last block is cut at a record.
4. Splitting tree: the drawn blocks of all sources are split among the output shards. At each node the left side's share of each source is a
   multivariate hypergeometric draw, so every shard is a fair sample and the blocks handed out are exactly those of the quota.
5. Records join their blocks' places; within a shard they are shuffled by a seeded hash. A shard has a bounded number of tokens, a block's records are
   in one shard for each copy, and all draws depend on the seed alone, so a lost executor's work comes out the same.

Defined results: null or empty texts and null sources take no part. A source on one side only gets nothing, and the report names it. A share or a
max_repeats that is null, zero or negative gives nothing. Ties are broken by id. Records repeated in the input are records of their own in counting
but have one place per copy of their id. Extra columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.cluster import env_path, materialize

#: A block has about BLOCK_TOKENS (a source at least LEAST_BLOCKS blocks, so that small sources mix too), a shard at most about SHARD_TOKENS. Sizes double
#: until all sources together have at most MOST_BLOCKS, which the driver plans; a shard then has as many tokens as SHARD_TOKENS or sixteen blocks.
BLOCK_TOKENS, LEAST_BLOCKS, SHARD_TOKENS, MOST_BLOCKS, SEED = 250_000, 64, 4_000_000, 2_000_000, 20_240_601
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def vocabulary_path() -> str:
    """Where the rank file of the tokenizer lies; CORPUSMILL_RANKS overrides it."""
    return env_path("CORPUSMILL_RANKS", "/opt/tokenizers/byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


#: tiktoken takes a text in pieces of so many characters, cut at blanks; only texts without a blank there can count a token more.
PIECE = 100_000


def count_tokens(text: str, path: str) -> int:
    encode, n, at = _encoding(path).encode_ordinary, 0, 0
    while len(text) - at > PIECE:
        cut = text.rfind(" ", at + 1, at + PIECE)
        cut = at + PIECE if cut <= at else cut
        n += len(encode(text[at:cut]))
        at = cut
    return n + len(encode(text[at:] if at else text))


def source_key(label: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(label)), r"[^a-z0-9]+", "_")


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", path: str | None = None) -> DataFrame:
    """(doc, source, tokens, rank), written once."""
    at = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [count_tokens(t, at) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc": b.column(0), "source": b.column(1), "tokens": pa.array(n, pa.int64())})

    rows = docs.where((F.col(text) != "") & F.col(source).isNotNull() & F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("bigint").alias("doc"), source_key(F.col(source)).alias("source"), text)
    counted = rows.mapInArrow(run, "doc bigint, source string, tokens bigint")
    rank = F.xxhash64(F.col("doc"), F.lit(SEED))
    return materialize(counted.withColumn("rank", rank))


def block_counts(tokens: dict[str, int], block_tokens: int = BLOCK_TOKENS, most: int = MOST_BLOCKS) -> tuple[dict[str, int], int]:
    """The number of blocks of each source, and the tokens that a block was made for."""
    while True:
        counts = {s: max(LEAST_BLOCKS, -(-n // block_tokens)) for s, n in tokens.items()}
        if sum(counts.values()) <= max(most, LEAST_BLOCKS * len(counts)):
            return counts, block_tokens
        block_tokens *= 2


def quotas(available: dict[str, int], targets: dict[str, tuple[float, int]], total: int | None = None) -> dict[str, int]:
    """Tokens wanted of each source."""
    able = {s: n * targets[s][1] for s, n in available.items() if n > 0 and s in targets and targets[s][0] > 0 and targets[s][1] > 0}
    if not able:
        return {}
    if total is None:
        whole = sum(targets[s][0] for s in able)
        scale = min(able[s] / targets[s][0] for s in able)
        return {s: int(scale * targets[s][0]) for s in able} if whole else {}
    # sources that can't give their share give all they can; the rest share what is left in proportion
    left, open_ = float(total), dict(able)
    out: dict[str, int] = {}
    while open_:
        whole = sum(targets[s][0] for s in open_)
        full = [s for s in open_ if open_[s] < left * targets[s][0] / whole]
        if not full:
            return out | {s: int(left * targets[s][0] / whole) for s in open_}
        for s in full:
            out[s] = able[s]
            del open_[s]
        left = total - sum(out.values())
    return out


def draw_blocks(blocks: dict[str, list[tuple[int, int]]], quota: dict[str, int], seed: int = SEED) -> list[tuple[str, int, int, int]]:
    """(source, block, copy, tokens to take of it): whole passes in permuted orders, the last block in part."""
    out = []
    for s in sorted(quota):
        rng = np.random.default_rng([seed, *s.encode()])
        left, copy = quota[s], 0
        while left > 0:
            copy += 1
            for k in rng.permutation(len(blocks[s])):
                block, tokens = blocks[s][k]
                take = min(tokens, left)
                if take > 0:
                    out.append((s, block, copy, int(take)))
                left -= take
                if left <= 0:
                    break
            if copy > 10_000:
                raise ValueError("a source without tokens has a quota")
    return out


def splitting_tree(counts: dict[str, int], shards: int, seed: int = SEED) -> list[dict[str, int]]:
    """How many of each source's blocks each shard gets: multivariate hypergeometric draws down a binary tree."""
    names = sorted(counts)

    def split(k: np.ndarray, first: int, n: int) -> list[np.ndarray]:
        if n == 1:
            return [k]
        half = n // 2
        rng = np.random.default_rng([seed, first, n])
        left = rng.multivariate_hypergeometric(k, int(k.sum()) * half // n, method="marginals") if k.sum() else k
        return split(left, first, half) + split(k - left, first + half, n - half)

    return [dict(zip(names, map(int, v), strict=True)) for v in split(np.array([counts[s] for s in names], np.int64), 0, shards)]


def plan(blocks: dict[str, list[tuple[int, int]]], targets: dict[str, tuple[float, int]], total: int | None = None, shard_tokens: int = SHARD_TOKENS) -> list[tuple[str, int, int, int, int]]:
    """(source, block, copy, tokens to take, shard)."""
    drawn = draw_blocks(blocks, quotas({s: sum(t for _, t in b) for s, b in blocks.items()}, targets, total))
    shards = max(1, -(-sum(d[3] for d in drawn) // shard_tokens))
    by_source: dict[str, list[tuple]] = {}
    for d in drawn:
        by_source.setdefault(d[0], []).append(d)
    leaves = splitting_tree({s: len(d) for s, d in by_source.items()}, shards)
    out = []
    for s, ds in by_source.items():
        order = iter(np.random.default_rng([SEED, 7, *s.encode()]).permutation(len(ds)))
        for shard, leaf in enumerate(leaves):
            out += [(*ds[next(order)], shard) for _ in range(leaf[s])]
    return out


def _targets(mix: DataFrame) -> dict[str, tuple[float, int]]:
    rows = mix.select(source_key(F.col("source")), "target_share", "max_repeats").where("source is not null").limit(10_001).collect()  # the wanted sources are few
    if len(rows) > 10_000:
        raise ValueError("more than 10,000 wanted sources")
    return {r[0]: (r[1] or 0.0, r[2] or 0) for r in rows}


def _mixed(docs: DataFrame, mix: DataFrame, total: int | None, path: str | None) -> tuple[DataFrame, DataFrame, dict]:
    targets = _targets(mix)
    counted = sizes(docs, path=path)
    wanted = counted.where(F.col("source").isin(sorted(targets)))
    counts, size = block_counts({r[0]: r[1] for r in wanted.groupBy("source").agg(F.sum("tokens")).collect()})  # a row per wanted source
    if counts:
        of = F.coalesce(*[F.when(F.col("source") == s, F.lit(n)) for s, n in counts.items()])
        wanted = wanted.withColumn("block", F.pmod("rank", of).cast("int"))
    else:
        wanted = wanted.withColumn("block", F.lit(0))
    blocks: dict[str, list[tuple[int, int]]] = {}
    for s, block, tokens in wanted.groupBy("source", "block").agg(F.sum("tokens")).orderBy("source", "block").collect():  # at most MOST_BLOCKS
        blocks.setdefault(s, []).append((block, tokens))
    placed = plan(blocks, targets, total, max(SHARD_TOKENS, 16 * size))
    spark = docs.sparkSession
    table = spark.createDataFrame(pa.table({n: pa.array([p[k] for p in placed], t) for k, (n, t) in enumerate((("source", pa.string()), ("block", pa.int32()), ("copy", pa.int32()), ("take", pa.int64()), ("shard", pa.int32())))}).to_pandas(), "source string, block int, copy int, take bigint, shard int")
    from pyspark.sql import Window

    # the records of a block in a fixed order, with the tokens before each: a block is cut where its part is full
    order = Window.partitionBy("source", "block").orderBy("rank", "doc")
    before = wanted.withColumn("before", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("tokens"))
    used = before.join(F.broadcast(table) if len(placed) <= 300_000 else table, ["source", "block"]).where(F.col("before") + F.col("tokens") / 2 <= F.col("take"))
    return used, counted, targets


def mixture(docs: DataFrame, mix: DataFrame, total: int | None = None, path: str | None = None) -> DataFrame:
    """(source, doc_id, copy, shard, position, tokens): the mixed corpus, a row for each use of a record."""
    from pyspark.sql import Window

    used, _, _ = _mixed(docs, mix, total, path)
    shuffled = Window.partitionBy("shard").orderBy(F.xxhash64("doc", "copy", F.lit(SEED + 1)), "doc", "copy")
    rows = used.dropDuplicates(["doc", "copy"])
    return rows.select("source", F.col("doc").alias("doc_id"), "copy", "shard", F.row_number().over(shuffled).alias("position"), "tokens")


def shares(docs: DataFrame, mix: DataFrame, total: int | None = None, path: str | None = None) -> DataFrame:
    """(source, target_share, max_repeats, available_tokens, used_tokens, actual_share, records, most_repeats), for every source of either side."""
    used, counted, _ = _mixed(docs, mix, total, path)
    have = counted.groupBy("source").agg(F.sum("tokens").alias("available_tokens"))
    per = used.dropDuplicates(["doc", "copy"]).groupBy("source").agg(F.sum("tokens").alias("used_tokens"), F.countDistinct("doc").alias("records"), F.max("copy").alias("most_repeats"))
    want = mix.where("source is not null").select(source_key(F.col("source")).alias("source"), "target_share", "max_repeats")
    zero = F.lit(0).cast("bigint")
    both = want.join(have, "source", "full_outer").join(per, "source", "left").select("source", "target_share", "max_repeats", F.coalesce("available_tokens", zero).alias("available_tokens"), F.coalesce("used_tokens", zero).alias("used_tokens"), F.coalesce("records", zero).alias("records"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"))
    whole = both.agg(F.sum("used_tokens").alias("_all"))
    return both.crossJoin(F.broadcast(whole)).withColumn("actual_share", F.when(F.col("_all") > 0, F.col("used_tokens") / F.col("_all"))).drop("_all")
