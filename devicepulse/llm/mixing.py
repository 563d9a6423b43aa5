"""Mixing sources to target weights in fixed-length blocks.

The words of each source are laid end to end and cut into blocks of a fixed length. The mix is made of
output shards of so many slots, a block to a slot. How many slots of a shard go to each source is the whole
part of its target share, and a stratified draw deals what is left: counts that scatter less than those of
a free multinomial, so that sources come near their targets. The j-th slot of a source over all shards takes block
j modulo the number of its blocks under a pseudorandom permutation of them, anew for every round through
them, and slots and blocks meet in a join by index.

No step orders a whole source: documents fall into buckets of a bounded number by a hash, each bucket is
packed into blocks on its own, and the blocks of a bucket begin where those of the buckets before it
end. A source that holds most rows has more buckets. All of it runs on (id, source, size) rows;
texts are only read to be counted, and once more where the mixed texts are wanted.

The short tables that several steps need, rows per source, bucket and shard, are stored. So they are made once, and no
plan holds those before it again and again, which the driver would plan anew after each of its stages.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from devicepulse.llm.common import SPACES, stored, words


@dataclass(frozen=True)
class Mix:
    """Weights go round the sources in code point order, null last. A source is taken at most
    `most_repeats` times over."""

    weights: tuple[float, ...] = (1.0, 2.0, 3.0)
    most_repeats: int = 3
    block_words: int = 64
    shard_slots: int = 4096
    bucket_docs: int = 2_000
    rounds: int = 24
    seed: int = 17


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """(source, source_size, n_docs) to the same with `source_no` from 1 and `target`, a double.

    The sizes are shared out by weight. Where a share is over `most_repeats` sizes it stops there, and
    what is left over is shared again. That ends at a level per weight: with the sources in the
    order of cap per weight, the first ones are capped and the others get the level times their weight.
    Windows over one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    numbered = sizes.withColumn("source_no", F.row_number().over(order))
    turn = (F.col("source_no") - 1) % len(mix.weights)
    weighted = numbered.withColumn(
        "weight", F.get(F.array(*[F.lit(float(w)) for w in mix.weights]), turn)
    ).withColumn("cap", (F.col("source_size") * mix.most_repeats).cast("double"))
    by_need = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    earlier = by_need.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    before = F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
    weights_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    left = weighted.withColumn("_left", F.sum("source_size").over(whole) - before).withColumn(
        "_weights", weights_left
    )
    # The first source that is not capped sets the level for itself and all after it.
    level = F.struct(F.col("cap") / F.col("weight"), F.col("source_no"), F.col("_left"), F.col("_weights"))
    free = F.col("_left") * F.col("weight") <= F.col("cap") * F.col("_weights")
    first = left.withColumn("_free", free).withColumn(
        "_level", F.min(F.when(F.col("_free"), level)).over(whole)
    )
    shared = F.col("_level._left") * F.col("weight") / F.col("_level._weights")
    capped = F.col("_level").isNull() | (level < F.col("_level"))
    return first.select(
        "source_no",
        "source",
        "source_size",
        "n_docs",
        F.when(capped, F.col("cap")).otherwise(F.least("cap", shared)).alias("target"),
    )


def _sized(docs: DataFrame, doc_id: str, text: str, source: str, mix: Mix) -> DataFrame:
    """(doc_id, source, mark, size): what packing needs of each row; stored, so texts are counted once."""
    mark = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    slim = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        mark.alias("mark"),
        F.size(words(F.col(f"`{text}`"))).cast("bigint").alias("size"),
    )
    return stored(slim, "sizes")


def _packed(sized: DataFrame, plan: DataFrame, mix: Mix) -> tuple[DataFrame, DataFrame]:
    """Rows with their place in their source's blocks, and `plan` with the number of blocks."""
    draw = F.xxhash64(F.lit(mix.seed), "doc_id", "mark")
    n_buckets = F.ceil(F.col("n_docs") / mix.bucket_docs)
    known = plan.withColumnRenamed("source", "_source")
    rows = (
        sized.join(known, F.col("source").eqNullSafe(F.col("_source")))
        .drop("_source")
        .withColumn("draw", draw)
        .withColumn("bucket", F.pmod("draw", n_buckets))
    )
    buckets = rows.groupBy("source_no", "bucket").agg(F.sum("size").alias("_words"))
    blocks = F.ceil(F.col("_words") / mix.block_words)
    upto = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select(
        "source_no",
        "bucket",
        blocks.alias("_blocks"),
        F.coalesce(F.sum(blocks).over(upto), F.lit(0)).alias("first_block"),
    )
    offsets = stored(offsets, "offsets")
    totals = offsets.groupBy("source_no").agg(F.sum("_blocks").alias("n_blocks"))
    inside = Window.partitionBy("source_no", "bucket").orderBy("draw", "doc_id", "size", "mark")
    placed = (
        rows.withColumn("place", F.row_number().over(inside))
        .withColumn("start", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
        .join(offsets.drop("_blocks"), ["source_no", "bucket"])
    )
    return placed, stored(plan.join(totals, "source_no"), "plan")


def _slots(plan: DataFrame, mix: Mix) -> DataFrame:
    """(shard, source_no, block): a row for each filled slot of the mix.

    A shard of m slots gives each source the whole part of m times its share; the slots that are left are
    drawn by the fractions, each from an equal stretch of them. So counts are those of a multinomial with
    little noise, and a source's total is near its target however many shards there are. A source never gets more
    slots than `most_repeats` rounds of its blocks; a slot beyond that stays empty.
    """
    # Blocks are not all full, so a source needs its target's share of its own blocks.
    asked = plan.where("source_size > 0").withColumn(
        "slots", F.col("target") * F.col("n_blocks") / F.col("source_size")
    )
    asked = asked.withColumn("_all", F.sum("slots").over(Window.partitionBy()))
    n_slots = F.round("_all").cast("bigint")
    n_shards = F.ceil(n_slots / mix.shard_slots)
    shares = asked.where(n_slots > 0).select(
        "source_no",
        "n_blocks",
        (F.col("slots") / F.col("_all")).alias("share"),
        n_slots.alias("n_slots"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), n_shards - 1)).alias("shard"),
    )
    room = F.least(F.lit(mix.shard_slots).cast("bigint"), F.col("n_slots") - F.col("shard") * mix.shard_slots)
    shard = Window.partitionBy("shard")
    upto = shard.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    part = room * F.col("share")
    base = F.floor(part)
    drawn = shares.select(
        "shard",
        "source_no",
        "n_blocks",
        base.alias("n"),
        F.coalesce(F.sum(part - base).over(upto), F.lit(0.0)).alias("begin"),
        F.sum(part - base).over(shard).alias("end"),
        (F.max(room).over(shard) - F.sum(base).over(shard)).alias("rest"),
    )
    drawn = stored(drawn, "drawn")
    # Each draw falls on the line of fractions; the source whose part begins last before it gets it.
    draws = (
        drawn.groupBy("shard")
        .agg(F.max("rest").alias("rest"), F.max("end").alias("end"))
        .where("rest > 0")
        .select("shard", "end", "rest", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rest"))).alias("i"))
    )
    chance = F.pmod(F.xxhash64(F.lit(mix.seed), "shard", "i"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    none = F.lit(None).cast("int").alias("source_no")
    place = (F.col("i") - 1 + chance) / F.col("rest") * F.col("end")
    line = drawn.select("shard", F.col("begin").alias("at"), "source_no", F.lit(0).alias("kind")).unionByName(
        draws.select("shard", place.alias("at"), none, F.lit(1).alias("kind"))
    )
    along = Window.partitionBy("shard").orderBy("at", "kind", "source_no")
    along = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    won = (
        line.withColumn("winner", F.last("source_no", ignorenulls=True).over(along))
        .where("kind = 1")
        .select("shard", F.col("winner").alias("source_no"), F.lit(1).cast("bigint").alias("n"))
    )
    counts = (
        drawn.select("shard", "source_no", "n").unionByName(won).groupBy("shard", "source_no").agg(F.sum("n").alias("n"))
    )
    earlier = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        counts.withColumn("first", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .where("n > 0")
        .join(plan.select("source_no", "n_blocks"), "source_no")
    )
    # Few rows that each make many: dealt over a number of partitions of their own, not by their size.
    parts = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slots = spans.repartition(parts, "shard", "source_no").select(
        "shard",
        "source_no",
        "n_blocks",
        F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("j"),
    ).where(F.col("j") < F.col("n_blocks") * mix.most_repeats)
    return slots.select("shard", "source_no", _permuted(mix).alias("block"))


def _permuted(mix: Mix) -> Column:
    """The block that slot j of a source takes.

    Each round of a swap-or-not shuffle pairs every index with another one and swaps the two or not, by
    a hash of the larger; so the whole is a permutation of the blocks, however many there are.
    """
    n = F.col("n_blocks")
    turn = F.floor(F.col("j") / n)

    def step(x: Column, r: Column) -> Column:
        partner = F.pmod(F.pmod(F.xxhash64(F.lit(mix.seed), "source_no", turn, r), n) - x, n)
        swap = F.xxhash64(F.lit(~mix.seed), "source_no", turn, r, F.greatest(x, partner)).bitwiseAND(1) == 1
        return F.when(swap, partner).otherwise(x)

    rounds = F.sequence(F.lit(1), F.lit(mix.rounds))
    return F.aggregate(rounds, F.pmod(F.col("j"), n).cast("bigint"), step)


def mix_pieces(
    docs: DataFrame, mix: Mix = Mix(), doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """A row for each document and block that it has words in, with how often the mix takes the block:
    (source_no, bucket, place, doc_id, source, mark, size, source_size, target, from_word, n_words, uses).

    `place` in a bucket tells repeated rows apart; from_word counts from 0. A document without words
    has one row, without a piece. Empty tables give no rows.
    """
    sized = _sized(docs, doc_id, text, source, mix)
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    placed, plan = _packed(sized, stored(targets(sizes, mix), "targets"), mix)
    uses = _slots(plan, mix).groupBy("source_no", "block").agg(F.count("*").alias("uses"))
    length = mix.block_words
    first, last = F.floor(F.col("start") / length), F.floor((F.col("start") + F.col("size") - 1) / length)
    cut = placed.select("*", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))).alias("_at"))
    begin = F.greatest(F.col("start"), F.col("_at") * length)
    end = F.least(F.col("start") + F.col("size"), (F.col("_at") + 1) * length)
    pieces = cut.select(
        "source_no",
        "bucket",
        "place",
        "doc_id",
        "source",
        "mark",
        "size",
        "source_size",
        "target",
        (begin - F.col("start")).alias("from_word"),
        (end - begin).alias("n_words"),
        (F.col("first_block") + F.col("_at")).alias("block"),
    )
    return pieces.join(uses, ["source_no", "block"], "left").withColumn("uses", F.coalesce("uses", F.lit(0)))


_ROW = ("source_no", "bucket", "place")


def mix_sources(
    docs: DataFrame, mix: Mix = Mix(), doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """A row for each input row: (doc_id, source, size, source_size, target, taken), in words.

    A null or empty text has size 0 and is never taken. Null sources are a source of their own. Repeated
    rows are packed one by one. The same rows give the same mix however they are spread.
    """
    pieces = mix_pieces(docs, mix, doc_id, text, source)
    taken = F.coalesce(F.sum(F.col("n_words") * F.col("uses")), F.lit(0)).cast("bigint")
    fixed = ["doc_id", "source", "size", "source_size", "target"]
    return (
        pieces.groupBy(*_ROW)
        .agg(*[F.first(c).alias(c) for c in fixed], taken.alias("taken"))
        .select(*fixed, "taken")
    )


def mixed_documents(
    docs: DataFrame, mix: Mix = Mix(), doc_id: str = "doc_id", text: str = "text", source: str = "source"
) -> DataFrame:
    """The mix as documents, with the columns and types of `docs`.

    A document has a row for each time that any of its words are taken: the c-th holds the words that
    the mix takes c times or more, in their order, with the white space before them. A text
    taken whole is unchanged. A column `n_chars`, if there is one, is counted anew.
    """
    pieces = mix_pieces(docs, mix, doc_id, text, source).where("uses > 0")
    spans = pieces.groupBy(*_ROW).agg(
        *[F.first(c).alias(c) for c in ("doc_id", "source", "mark")],
        F.array_sort(F.collect_list(F.struct("from_word", "n_words", "uses"))).alias("spans"),
    )
    copies = spans.select(
        F.struct("doc_id", "source", "mark").alias("__key"),
        "spans",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.array_max(F.col("spans.uses")))).alias("copy"),
    ).select("__key", F.filter("spans", lambda s: s["uses"] >= F.col("copy")).alias("__spans"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    key = F.struct(
        F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), F.xxhash64(*columns).alias("mark")
    )
    # Rows that agree in all columns are one text with several places.
    texts = docs.select(key.alias("__key"), F.struct(*columns).alias("__row"))
    texts = texts.groupBy("__key").agg(F.first("__row").alias("__row"))
    whole = F.coalesce(F.col(f"__row.`{text}`"), F.lit(""))
    found = F.regexp_extract_all(whole, F.lit(f"[{SPACES}]*[^{SPACES}]+(?:[{SPACES}]+$)?"), F.lit(0))
    # A generator stands between the words and what is made of them, else the optimizer would cut the text into
    # words anew for each span.
    joined = copies.join(texts, "__key").select("__row", "__spans", F.explode(F.array(found)).alias("__words"))
    cut = F.array_join(
        F.flatten(
            F.transform(
                "__spans", lambda s: F.slice("__words", (s["from_word"] + 1).cast("int"), s["n_words"].cast("int"))
            )
        ),
        "",
    )
    made = joined.select("__row", cut.alias("__cut"))
    types = dict(docs.dtypes)

    def column(name: str) -> Column:
        if name == text:
            return F.col("__cut").cast(types[name]).alias(name)
        if name == "n_chars":
            return F.length("__cut").cast(types[name]).alias(name)
        return F.col(f"__row.`{name}`").alias(name)

    return made.select(*[column(c) for c in docs.columns])


def shares(taken: DataFrame) -> DataFrame:
    """(source, source_size, target, taken): the mix by source, to hold against its targets."""
    return taken.groupBy("source").agg(
        F.first("source_size").alias("source_size"),
        F.first("target").alias("target"),
        F.sum("taken").alias("taken"),
    )
