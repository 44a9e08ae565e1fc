"""Mixing sources to target weights with a low-discrepancy schedule."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rxlake.llm.common import WORD_PATTERN, cut

#: Weights dealt to the sources in code point order (null last), repeating.
WEIGHTS = (5, 2, 1)
#: Times a source (and so each of its documents) may be used.
MOST_USES = 3
#: About so many slots of equal token blocks make the mix (log2), and one more
#: at most for each use of a source smaller than a block.
SLOT_BITS = 18
#: Hash ranges by which a source's running sums are split over tasks.
RANGES = 1024


def source_targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target``: weights share all words, a target stops
    at MOST_USES times its source, the excess goes to the others by weight.

    That is water filling: with sources ordered by size per weight, the first
    k are full and the others take ``rate`` x weight; k is the first for which
    the next source is not filled.  The windows run over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    upto = ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = (
        per.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank % len(WEIGHTS) + 1).cast("int")))
        .withColumn("ratio", F.col("source_size") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(every))
        .withColumn("weights", F.sum("weight").over(every))
        # rate if all sources before this one are full and this one is not
        .withColumn("_full", MOST_USES * (F.sum("source_size").over(upto) - F.col("source_size")))
        .withColumn("_open", F.col("weights") - F.sum("weight").over(upto) + F.col("weight"))
        .withColumn("rate", (F.col("total") - F.col("_full")) / F.col("_open"))
        .withColumn("_at", F.when(F.col("rate") <= MOST_USES * F.col("ratio"), F.col("rate")))
        .withColumn("rate", F.first("_at", ignorenulls=True).over(ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    target = F.least(F.col("rate") * F.col("weight"), MOST_USES * F.col("source_size").cast("double"))
    return filled.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _running(rows: DataFrame, value: str, parts: list[str], order: list[str], chunk: str, out: str) -> DataFrame:
    """``rows`` with ``out``: the sum of ``value`` over the rows before in
    ``order`` within ``parts``.  ``chunk`` (monotone in the order) splits a
    large part over tasks: sums inside a chunk, then over the chunks' totals."""
    inside = Window.partitionBy(*parts, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    across = Window.partitionBy(*parts).orderBy(chunk).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = rows.groupBy(*parts, chunk).agg(F.sum(value).alias("_sum"))
    totals = totals.select(
        *[F.col(p).alias(f"_{p}") for p in parts], F.col(chunk).alias("_chunk"), (F.sum("_sum").over(across) - F.col("_sum")).alias("_before")
    )
    same = [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in parts]
    joined = rows.join(totals, [*same, F.col(chunk) == F.col("_chunk")])
    inner = F.sum(value).over(inside) - F.col(value)
    return joined.withColumn(out, inner + F.col("_before")).drop("_chunk", "_before", *[f"_{p}" for p in parts])


def schedule(sources: DataFrame) -> DataFrame:
    """``slot, sid, block, use, limit``: the mix in order.

    ``sources``: ``sid, source_size, target, blocks``.  Slot k draws the
    van der Corput point of k (its bits reversed) through the cumulative
    slots wanted per source; the r-th slot of a source takes its block
    r mod blocks.  The points of one period are at least as many as all slots
    wanted, so every slot has a point of its own.  A source takes its target
    to the word: slots drawn beyond it stay empty, slots it was not drawn for
    follow the others (in turn over the sources), and of the last block only
    the first ``limit`` words are taken (null: all).
    """
    due = F.round("target").cast("long")
    want = (
        sources.filter("blocks > 0")
        .withColumn("want", F.col("target") / F.col("source_size") * F.col("blocks"))
        .withColumn("_rest", due % F.col("source_size"))  # words of the use that is cut
        .withColumn("_last", F.expr("(_rest * blocks + source_size - 1) div source_size"))  # blocks they reach into
        .withColumn("quota", F.expr("cast(round(target) as bigint) div source_size * blocks + _last"))
        .withColumn("limit", F.expr("case when _rest > 0 then _rest - ((_last - 1) * source_size div blocks) end"))
    )
    edge = F.sum("want").over(Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cells = F.expr("shiftleft(1L, bits)")
    ranges = (
        want.withColumn("high", edge)
        .withColumn("all", F.sum("want").over(every))
        .withColumn("turn", F.max("sid").over(every) + F.lit(1).cast("long"))
        .withColumn("bits", F.greatest(F.lit(SLOT_BITS), F.ceil(F.log2("all")).cast("int")))
        .select(
            "sid", "blocks", "quota", "limit", "turn", "bits", F.round("all").cast("long").alias("slots"),
            F.ceil((F.col("high") - F.col("want")) / F.col("all") * cells).alias("from"),
            F.least(F.ceil(F.col("high") / F.col("all") * cells), cells).alias("to"),
        )
    )
    # point p / cells is drawn at slot reverse(p)
    drawn = ranges.filter("`to` > `from`").select(
        "sid", "slots", "bits", F.explode(F.sequence(F.col("from"), F.col("to") - 1)).alias("point")
    )
    slot = F.conv(F.reverse(F.lpad(F.bin("point"), F.col("bits"), F.lit("0"))), 2, 10).cast("long")
    slots = (
        drawn.withColumn("slot", slot)
        .filter("slot < slots")
        .select("sid", "slot", F.lit(1).cast("long").alias("one"))
        .withColumn("chunk", F.floor(F.col("slot") / F.lit(1 << max(0, SLOT_BITS - 8))))
    )
    ranked = _running(slots, "one", ["sid"], ["slot"], "chunk", "rank").select("sid", "slot", "rank")
    count = slots.groupBy(F.col("sid").alias("_sid")).agg(F.count("*").alias("_n"))
    first = F.coalesce("_n", F.lit(0).cast("long"))
    missing = (
        ranges.join(count, F.col("sid") == F.col("_sid"), "left")
        .filter(F.col("quota") > first)
        .select("sid", "slots", "turn", first.alias("first"), F.explode(F.sequence(first, F.col("quota") - 1)).alias("rank"))
        .select("sid", (F.col("slots") + (F.col("rank") - F.col("first")) * F.col("turn") + F.col("sid")).alias("slot"), "rank")
    )
    of = ranges.select(F.col("sid").alias("_sid"), "blocks", "quota", "limit")
    used = ranked.unionByName(missing).join(of, F.col("sid") == F.col("_sid")).filter("rank < quota")
    return used.select(
        "slot", "sid", (F.col("rank") % F.col("blocks")).alias("block"), F.floor(F.col("rank") / F.col("blocks")).alias("use"),
        F.when(F.col("rank") == F.col("quota") - 1, F.col("limit")).alias("limit"),
    )


def mix(docs: DataFrame, *, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(documents, pieces) of the mix.

    documents: ``rid`` (row number), ``doc_id, source, size, source_size,
    target``.  pieces: ``slot, rid, first_word, words, use``: slot by slot,
    the runs of words that the mix takes.

    A source's documents, in hash order, form one stream that is cut into
    blocks of equal tokens; ``schedule`` decides which block fills which slot,
    and a block's documents are joined to it.  Every source, however small, is
    taken to its target, rounded to whole words.  Running sums over a hot source
    are split by hash range.  Null text has size 0; empty documents and
    sources are never taken; the null source is a source of its own (last);
    repeated rows are documents of their own.
    """
    size = F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
    order = F.xxhash64(F.col("doc_id"), F.lit(seed))
    sizes = cut(
        docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), size.alias("size"))
        .withColumn("rid", F.monotonically_increasing_id())
    )
    targets = source_targets(sizes)
    named = targets.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    length = F.ceil(F.sum("source_size").over(every) / F.lit(1 << SLOT_BITS))
    sources = cut(named.withColumn("blocks", F.coalesce(F.ceil(F.col("source_size") / length), F.lit(0)).cast("long")))
    linked = sources.select(F.col("source").alias("_s"), "sid", "source_size", "target", "blocks")
    documents = sizes.join(linked, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    ordered = documents.filter("size > 0").select("rid", "size", "sid", "source_size", "blocks", order.alias("order"))
    ordered = ordered.withColumn("chunk", F.shiftright("order", 64 - RANGES.bit_length() + 1))
    placed = _running(ordered, "size", ["sid"], ["order", "rid"], "chunk", "at")
    # block b of a source covers stream words [b * source_size div blocks, (b + 1) * source_size div blocks)
    block_of = lambda w: F.floor((w * F.col("blocks") + F.col("blocks") - 1) / F.col("source_size"))
    edge = lambda b: F.floor(b * F.col("source_size") / F.col("blocks"))
    parts = placed.withColumn("b", F.explode(F.sequence(block_of(F.col("at")) - 1, block_of(F.col("at") + F.col("size") - 1) + 1)))
    parts = (
        parts.withColumn("lo", F.greatest(F.col("at"), edge(F.col("b"))))
        .withColumn("hi", F.least(F.col("at") + F.col("size"), edge(F.col("b") + 1)))
        .filter((F.col("b") >= 0) & (F.col("b") < F.col("blocks")) & (F.col("lo") < F.col("hi")))
        .select(
            "sid", F.col("b").alias("block"), "rid", (F.col("lo") - F.col("at")).alias("first_word"), (F.col("hi") - F.col("lo")).alias("words"),
            (F.col("lo") - edge(F.col("b"))).alias("offset"),
        )
    )
    words = F.when(F.col("limit").isNull(), F.col("words")).otherwise(F.least(F.col("words"), F.col("limit") - F.col("offset")))
    pieces = schedule(sources).join(parts, ["sid", "block"]).withColumn("words", words).filter("words > 0")
    pieces = pieces.select("slot", "rid", "first_word", "words", "use")
    return documents, pieces


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """``rid, doc_id, size, source_size, target, taken, first_slot, n_slots`` of
    every row: the words the mix takes, the first slot of the mix that holds
    some of them (null: none) and how many slots do."""
    documents, pieces = mix(docs, **options)
    taken = pieces.groupBy("rid").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"), F.count("*").alias("n_slots"))
    none = F.lit(0).cast("long")
    return documents.join(taken, "rid", "left").select(
        "rid", "doc_id", "size", "source_size", "target", F.coalesce(F.col("taken").cast("long"), none).alias("taken"),
        "first_slot", F.coalesce("n_slots", none).alias("n_slots"),
    )


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input's columns, each document as often as the mix takes its words,
    to the nearest whole number (all but the one at each source's border are
    taken whole), in the order of the mix: partitions are ranges of slots, and
    a document's u-th copy stands where its u-th use begins, so what reads the
    rows in order sees every source in its share.

    Documents without words stay once, at a slot hashed from their id.  Rows
    repeating an id (or without one) share their taken words evenly."""
    documents, pieces = mix(docs, id_col=id_col, text_col=text_col, **options)
    uses = [F.min(F.when(F.col("use") == u, F.col("slot"))).alias(f"_u{u}") for u in range(MOST_USES)]
    taken = pieces.groupBy("rid").agg(F.sum("words").alias("taken"), *uses)
    per_id = documents.join(taken, "rid", "left").groupBy("doc_id").agg(
        F.coalesce(F.sum("taken"), F.lit(0)).alias("t"), F.sum("size").alias("s"), *[F.min(f"_u{u}").alias(f"_u{u}") for u in range(MOST_USES)]
    )
    copies = F.when(F.col("s") == 0, 1).otherwise(F.floor(F.col("t") / F.col("s") + 0.5)).cast("int")
    anywhere = F.pmod(F.xxhash64("doc_id"), F.lit(1 << SLOT_BITS))
    places = [F.coalesce(F.col(f"_u{u}"), *[F.col(f"_u{v}") for v in range(u - 1, -1, -1)], anywhere) for u in range(MOST_USES)]
    planned = per_id.withColumn("_copies", copies).filter("_copies > 0").select(
        F.col("doc_id").alias("_id"), F.slice(F.array(*places), 1, F.col("_copies")).alias("_slots")
    )
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    repeated = rows.join(planned, F.col(f"row.`{id_col}`").eqNullSafe(F.col("_id"))).select("row", F.explode("_slots").alias("_slot"))
    tie = F.xxhash64(F.col(f"row.`{text_col}`"))
    ordered = repeated.withColumn("_tie", tie).repartitionByRange("_slot", "_tie").sortWithinPartitions("_slot", "_tie")
    return ordered.select("row.*")
