"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Native: DataFrame and SQL functions only. Documents are cut into blocks of words; a
source's target is some whole passes over it and a rest, drawn without replacement. Blocks
are permuted over the output shards, which all sources share. The rest of a source is a
quota in words: a tree of fan-out FAN over the shards divides it, each node's share drawn from
the hypergeometric distribution given its words, so the shares add up exactly. In a shard a
source's blocks are taken in permuted order until its quota is used up; the last block is
taken in part. What a shard holds, whole passes included, is ordered by slots that shuffle it.

There are as many shards as the largest source needs to have about LEAF blocks in each, so a
hot source has more shards, not larger ones. Copies of one row are numbered, so they are
spread like any other rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, word_count

WEIGHTS, SHARE, CAP = (3, 1, 2), 1.5, 2.0
BLOCK, LEAF, FAN = 128, 256, 64
SEED = 20_240_607
#: A draw inverts the distribution function, summed over so many deviations on either side
#: of the mode; what lies beyond is less than a double's grain of 2 ** -53.
DEVIATIONS = 9


def _ordered(df: DataFrame, *by: Column) -> DataFrame:
    """df in a global order: part (of the order) and place, without a task that has all rows."""
    at = F.monotonically_increasing_id()
    out = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("place", at)
    return materialise(out.withColumn("part", F.shiftright("place", 33)), "ordered")


def _before(rows: DataFrame, **sums: Column) -> DataFrame:
    """Rows in an order with the sums of all rows before each; a row a part is summed up in one task."""
    per = rows.groupBy("part").agg(*[F.sum(c).alias(f"p_{n}") for n, c in sums.items()])
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("part").alias("of"), *[F.coalesce(F.sum(f"p_{n}").over(earlier), F.lit(0)).alias(f"o_{n}") for n in sums])
    own = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({n: F.coalesce(F.sum(c).over(own), F.lit(0)) for n, c in sums.items()})
    rows = rows.join(per, F.col("part") == F.col("of"))
    return rows.withColumns({n: F.col(n) + F.col(f"o_{n}") for n in sums}).drop("of", "part", "place", *[f"o_{n}" for n in sums])


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size, weight, target, n_blocks): one row per source.

    Sources by code point, null last, take the weights in turn. Targets add up to share
    times all sizes and stop at cap times the source's size, the excess being shared anew by
    weight (one pass over the sources in order of cap / weight).
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum("n_blocks").alias("n_blocks"))
    per = _before(_ordered(per, F.col("source").asc_nulls_last()), turn=F.lit(1))
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("turn") % len(weights) + 1).cast("int")))
    per = per.withColumn("most", F.col("source_size") * F.lit(cap)).withColumn("ratio", F.col("most") / F.col("weight"))
    per = _before(_ordered(per, F.col("ratio"), F.col("source").asc_nulls_last()), full=F.col("most"), lighter=F.col("weight"))
    per = materialise(per, "levels")
    zero = F.lit(0.0)
    every, weight = per.agg(F.coalesce(F.sum(F.col("source_size").cast("double")), zero), F.coalesce(F.sum("weight"), zero)).first()
    level = (F.lit(every * share) - F.col("full")) / (F.lit(weight) - F.col("lighter"))
    free = per.agg(F.max(F.when(level <= F.col("ratio"), level))).first()[0]
    target = F.least(F.col("most"), F.lit(free).cast("double") * F.col("weight")) if free is not None else F.col("most")
    return per.select("source", "source_size", "weight", target.alias("target"), "n_blocks")


#: One hypergeometric draw: s has N (all words), K (words of the child), q (quota) and u.
_MODE = "cast(floor((s.q + 1D) * (s.K + 1D) / (s.N + 2D)) as bigint)"
_DRAW = f"""transform(transform(array(s0), s -> named_struct(
  'N', s.N, 'K', s.K, 'q', s.q, 'u', s.u,
  'lo', greatest(0L, s.q - (s.N - s.K)), 'hi', least(s.q, s.K),
  'var', cast(s.q as double) * (cast(s.K as double) / greatest(s.N, 1L)) * (1D - cast(s.K as double) / greatest(s.N, 1L)) * (cast(s.N - s.q as double) / greatest(s.N - 1L, 1L)))),
 s -> case
  when s.hi <= s.lo then s.lo
  else transform(transform(array(named_struct(
    'from', greatest(s.lo, {_MODE} - 6L - cast({DEVIATIONS}D * sqrt(s.var) as bigint)),
    'to', least(s.hi, {_MODE} + 6L + cast({DEVIATIONS}D * sqrt(s.var) as bigint)))), w -> named_struct('from', w.from, 'to', w.to,
    'all', aggregate(sequence(w.from, w.to), named_struct('w', 1D, 't', 0D),
      (b, i) -> named_struct('w', b.w * (cast(s.K - i as double) * (s.q - i)) / (cast(i + 1 as double) * (s.N - s.K - s.q + i + 1)), 't', b.t + b.w), b -> b.t))),
    w -> aggregate(sequence(w.from, w.to), named_struct('w', 1D, 't', 0D, 'x', -1L),
      (b, i) -> named_struct('w', b.w * (cast(s.K - i as double) * (s.q - i)) / (cast(i + 1 as double) * (s.N - s.K - s.q + i + 1)), 't', b.t + b.w,
        'x', if(b.x < 0L and b.t + b.w >= s.u * w.all, i, b.x)), b -> if(b.x < 0L, w.to, b.x)))[0]
 end)[0]"""


def _split(children: DataFrame, quotas: DataFrame, level: int, seed: int) -> DataFrame:
    """(src, node, words, quota) of the children, given the quotas of their parents."""
    u = (F.shiftrightunsigned(F.xxhash64("src", "node", F.lit(level), F.lit(seed)), 11) + 0.5) / float(1 << 53)
    own = children.select("src", (F.col("node") / FAN).cast("long").alias("up"), F.struct("node", "words", u.alias("u")).alias("c"))
    own = own.groupBy("src", "up").agg(F.sort_array(F.collect_list("c")).alias("cs"), F.sum("c.words").alias("n"))
    own = own.join(quotas.select("src", F.col("node").alias("up"), "quota"), ["src", "up"])
    fold = f"""aggregate(cs, named_struct('n', n, 'q', quota, 'out', cast(array() as array<struct<node:bigint,words:bigint,quota:bigint>>)),
      (a, c) -> transform(transform(array(named_struct('N', a.n, 'K', c.words, 'q', a.q, 'u', c.u)), s0 -> {_DRAW}),
        x -> named_struct('n', a.n - c.words, 'q', a.q - x, 'out', concat(a.out, array(named_struct('node', c.node, 'words', c.words, 'quota', x)))))[0],
      a -> a.out)"""
    return own.select("src", F.explode(F.expr(fold)).alias("o")).select("src", "o.node", "o.words", "o.quota")


def numbered(sized: DataFrame) -> DataFrame:
    """key made unique: copies of one row are numbered, by part of the table and in it, so that
    no task has all copies of a row."""
    twice = materialise(sized.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "copies")
    if twice.isEmpty():
        return sized
    part = F.shiftright("rid", 33).alias("part")
    some = sized.join(twice, "key", "left_semi").select("rid", "key", part)
    per = some.groupBy("key", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("key", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("o"))
    place = F.row_number().over(Window.partitionBy("key", "part").orderBy("rid"))
    some = some.withColumn("k", place).join(per, ["key", "part"]).select(F.col("rid").alias("c_rid"), (F.col("k") + F.col("o")).alias("copy"))
    out = sized.join(some, F.col("rid") == F.col("c_rid"), "left")
    return out.withColumn("key", F.when(F.col("copy") > 1, F.xxhash64("key", "copy")).otherwise(F.col("key"))).drop("c_rid", "copy")


def mix(sized: DataFrame, block: int = BLOCK, seed: int = SEED, leaf: int = LEAF, **how) -> tuple[DataFrame, DataFrame, int]:
    """(whole, drawn, shards). sized: rid (unique), key (long hash of the row's content), source, size.

    whole: rid, key, source, source_size, target, passes (whole passes that every document of the
    source gets). drawn: rid, first (word), words, shard, slot: the disjoint blocks of the
    rest; slot shuffles a shard. Draws depend on content and seed only, so reruns agree, and
    identical rows are interchangeable. Empty documents and tables take part with nothing.
    """
    n_blocks = F.ceil(F.col("size") / block).cast("long")
    sized = numbered(sized).withColumn("n_blocks", n_blocks)
    per = targets(sized, **how)
    goal = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long")
    per = per.withColumns({"src": F.xxhash64("source", F.col("source").isNull()), "passes": passes})
    per = per.withColumn("rest", goal - F.col("passes") * F.col("source_size"))
    per = materialise(per, "sources")
    shards = -(-(per.agg(F.max("n_blocks")).first()[0] or 1) // leaf) or 1
    s = per.withColumnRenamed("source", "s_source").drop("n_blocks")
    whole = sized.join(s, F.col("source").eqNullSafe(F.col("s_source")), "left")
    blocks = whole.where("rest > 0 and size > 0").select("rid", "key", "src", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).alias("i"))
    blocks = blocks.select("rid", "src", (F.col("i") * block).alias("first"), F.least(F.lit(block).cast("long"), F.col("size") - F.col("i") * block).alias("bw"), F.xxhash64("key", "i", F.lit(seed)).alias("perm"), F.pmod(F.xxhash64("key", "i", F.lit(seed + 9)), F.lit(shards).cast("long")).alias("node"))
    levels = [materialise(blocks.groupBy("src", "node").agg(F.sum("bw").alias("words")), "leaves")]
    most = shards
    while most > 1:
        most = -(-most // FAN)
        up = (F.col("node") / FAN).cast("long")
        levels.append(levels[-1].groupBy("src", up.alias("node")).agg(F.sum("words").alias("words")))
    top = levels.pop() if len(levels) > 1 else levels[0]
    quotas = top.join(per.select("src", "rest"), "src").select("src", "node", F.col("rest").alias("quota"))
    quotas = reduce(lambda q, kv: _split(kv[1], q, kv[0], seed), [(i, levels[i]) for i in range(len(levels) - 1, -1, -1)] if top is not levels[0] else [], quotas)
    quotas = materialise(quotas.select("src", "node", "quota"), "quotas")
    order = Window.partitionBy("src", "node").orderBy("perm", "bw", "first", "rid")
    drawn = blocks.join(quotas, ["src", "node"])
    drawn = drawn.withColumn("before", F.sum("bw").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("bw"))
    words = F.greatest(F.lit(0).cast("long"), F.least(F.col("bw"), F.col("quota") - F.col("before")))
    drawn = drawn.withColumn("words", words).where("words > 0")
    drawn = drawn.select("rid", "first", "words", F.col("node").alias("shard"), F.xxhash64("perm", F.lit(seed + 17)).alias("slot"))
    return whole.select("rid", "key", "source", "source_size", "target", "passes"), drawn, shards


def sized_docs(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    return docs.select(F.monotonically_increasing_id().alias("rid"), F.xxhash64("doc_id", "source", "text").alias("key"), "doc_id", "source", word_count(text).alias("size"))


def taken(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of docs.

    Null, empty and blank texts have size 0 and are taken with 0 words; a null source is a source
    of its own, ordered last; repeated rows are rows of their own, and which of equal rows gets
    which share is not defined. An empty table gives no rows. Other columns are not read, so
    their names never clash.
    """
    sized = materialise(sized_docs(docs), "sized")
    whole, drawn, _ = mix(sized.select("rid", "key", "source", "size"))
    part = drawn.groupBy("rid").agg(F.sum("words").alias("part"))
    out = sized.select("rid", "doc_id", "size").join(whole.select("rid", "source_size", "target", "passes"), "rid").join(part, "rid", "left")
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("passes") + F.coalesce("part", F.lit(0))).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, seed: int = SEED, leaf: int = LEAF) -> DataFrame:
    """The mix as documents, by output shard and shuffled in it: columns of docs, a row for each
    whole pass over a document and one for what each shard draws of it, those blocks in their
    order in the text; n_chars follows the text. Partitions hold whole shards, each in the order
    of its slots, so a file written from one reads shard after shard. Texts without words come once
    for each whole pass, as they are; an empty table gives no rows."""
    src = docs.select(F.monotonically_increasing_id().alias("rid"), "text", F.struct(*[c for c in docs.columns if c != "text"]).alias("row"))
    src = materialise(src, "mix", compression="zstd")
    key = F.xxhash64("row.doc_id", "row.source", "text").alias("key")
    sized = src.select("rid", key, "row.source", word_count(F.col("text")).alias("size"))
    whole, drawn, shards = mix(sized, seed=seed, leaf=leaf)
    none = F.lit(None).cast("array<struct<first:bigint,words:bigint>>").alias("span")
    copy = whole.where("passes > 0").select("rid", "key", F.explode(F.sequence(F.lit(1).cast("long"), F.col("passes"))).alias("pass"))
    shard = F.pmod(F.xxhash64("key", "pass", F.lit(seed + 9)), F.lit(shards).cast("long"))
    copy = copy.select("rid", shard.alias("shard"), F.xxhash64("key", "pass", F.lit(seed + 17)).alias("slot"), none)
    parts = drawn.groupBy("rid", "shard").agg(F.min("slot").alias("slot"), F.sort_array(F.collect_list(F.struct("first", "words"))).alias("span"))
    places = copy.unionByName(parts).groupBy("rid").agg(F.collect_list(F.struct("shard", "slot", "span")).alias("p"))
    rows = src.join(places, "rid").withColumn("p", F.explode("p")).select("rid", "text", "row", "p.*")
    found = r"regexp_extract_all(text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+', 0)"
    text = F.expr(f"if(span is null, text, array_join(flatten(transform(array({found}), p -> flatten(transform(span, s -> slice(p, cast(s.first + 1 as int), cast(s.words as int)))))), ''))")
    rows = rows.select("row", text.alias("text"), "shard", "slot", "rid").repartition("shard").sortWithinPartitions("shard", "slot", "rid")
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return rows.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
