"""Chat formatting by quotation linking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxlake.llm.common import cut, numbered, once

#: A line's quote markers: any run of ">" with blanks between.
MARKERS = r"^[ \t]*(?:>[ \t]*)+"
#: A line that only announces the quote below it.
ATTRIBUTION = r"(?i)(wrote|écrit|schrieb|escribió) ?: *$"
#: Turns of one conversation and passage that one window handles at a time.
TURNS = 256


def _lines(text: Column) -> Column:
    """``level`` (markers before the line) and ``body`` of every line."""
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), r"\r?\n"),
        lambda line: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(line, MARKERS, 0), "[^>]", "")).alias("level"),
            F.trim(F.regexp_replace(line, MARKERS, "")).alias("body"),
        ),
    )


def _blocks(lines: Column) -> Column:
    """Runs of lines of one level (blank lines end a run): ``level, body``."""
    empty = F.array().cast("array<struct<level:int,body:string>>")
    start = F.struct(empty.alias("done"), F.lit(-1).alias("level"), F.lit("").alias("body"))

    def closed(s: Column) -> Column:
        return F.when(s["body"] == "", s["done"]).otherwise(F.concat(s["done"], F.array(F.struct(s["level"], s["body"]))))

    def step(s: Column, line: Column) -> Column:
        same = (line["level"] == s["level"]) & (line["body"] != "")
        return F.struct(
            F.when(same, s["done"]).otherwise(closed(s)).alias("done"),
            line["level"].alias("level"),
            F.when(same, F.concat_ws("\n", s["body"], line["body"])).otherwise(line["body"]).alias("body"),
        )

    return F.aggregate(lines, start, step, closed)


def normalised(passage: Column) -> Column:
    """Case, white space and punctuation at the ends do not tell passages apart."""
    return F.trim(F.regexp_replace(F.lower(passage), r"[\s\p{Punct}]+", " "))


def _own_text(lines: Column) -> Column:
    """The message without quoted lines and the lines that announce them."""
    kept = F.filter(
        lines,
        lambda x, i: (x["level"] == 0)
        & ~(x["body"].rlike(ATTRIBUTION) & (F.coalesce(F.get(lines, i + 1)["level"], F.lit(0)) > 0)),
    )
    text = F.array_join(F.transform(kept, lambda x: x["body"]), "\n")
    return F.trim(F.regexp_replace(text, r"\n{3,}", "\n\n"))


def latest_before(quotes: DataFrame, originals: DataFrame, keys: list[str], turn: str) -> DataFrame:
    """``quotes`` with ``found``: the greatest ``turn`` below its own among the
    originals with the same keys (null: none).

    One pass in turn order, cut into chunks of TURNS turns so that a passage
    or conversation holding a large share of the rows is spread over tasks; a
    chunk starts from the greatest turn of the chunks before it.
    """
    # an original sorts behind the quotes of its own turn: it is no answer to itself
    both = quotes.withColumn("_o", F.lit(0)).unionByName(originals.select(*keys, turn).withColumn("_o", F.lit(1)), allowMissingColumns=True)
    both = both.withColumn("_chunk", F.floor(F.col(turn) / TURNS))
    seen = F.when(F.col("_o") == 1, F.col(turn))
    inside = Window.partitionBy(*keys, "_chunk").orderBy(turn, "_o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tops = both.filter("_o = 1").groupBy(*keys, "_chunk").agg(F.max(turn).alias("_top"))
    chunks = both.select(*keys, "_chunk").distinct().join(tops.withColumnsRenamed({k: f"_{k}" for k in keys} | {"_chunk": "_c"}), [*[F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.col("_chunk").eqNullSafe(F.col("_c"))], "left")
    across = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = chunks.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("_chunk").alias("_c"), F.max("_top").over(across).alias("_carried"))
    joined = both.withColumn("_in", F.max(seen).over(inside)).filter("_o = 0").join(
        carried, [*[F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.col("_chunk").eqNullSafe(F.col("_c"))], "left"
    )
    return joined.withColumn("found", F.coalesce("_in", "_carried")).select(*quotes.columns, "found")


def link_quotes(
    messages: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Messages in reply order without their quotes: ``conv_id, turn, role,
    reply_to, root_turn, position, quote_levels, n_quotes, n_linked, text``.

    Quote levels are counted from the markers of each line; runs of one level
    are passages, hashed after normalisation.  A passage is joined to the
    latest earlier message of its conversation that holds it as its own text
    (the whole message, one of its blocks, or one of its lines).  A message
    replies to the original of its first linked passage of the lowest level;
    ``root_turn`` follows replies to the start of the thread, and messages are
    ordered thread by thread (``position`` from 0), replies behind what they
    answer.  A message without links starts its own thread, so conversations
    without quotes keep their turn order.

    Null text counts as empty; null conversation ids form one conversation;
    null turns sort first and link with nothing; messages of one turn are
    ordered by a hash of text and role; repeated rows keep a row each and take
    consecutive positions; a passage links only if it equals a whole message,
    block or line; an empty table gives no rows.
    """
    lines = _lines(F.col("text"))
    base = messages.select(
        F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), F.col(f"`{role_col}`").alias("role"), F.col(f"`{text_col}`").alias("text")
    )
    parsed = base.withColumn("lines", once(lines)).withColumn("blocks", once(_blocks(F.col("lines"))))
    parsed = parsed.withColumn("own", _own_text(F.col("lines")))
    quoted = F.filter("blocks", lambda b: b["level"] > 0)
    rows = cut(
        parsed.select(
            F.monotonically_increasing_id().alias("row"), "conv_id", "turn", "role", F.col("own").alias("text"),
            F.coalesce(F.array_max(F.transform(quoted, lambda b: b["level"])), F.lit(0)).alias("quote_levels"),
            F.transform(quoted, lambda b: F.struct(b["level"].alias("level"), normalised(b["body"]).alias("body"))).alias("quotes"),
        )
    )
    quotes = (
        rows.filter(F.col("turn").isNotNull())
        .select("row", "conv_id", "turn", F.posexplode("quotes").alias("at", "q"))
        .select("row", "conv_id", "turn", "at", F.col("q.level").alias("level"), F.col("q.body").alias("passage"))
        .filter("passage <> ''")
        .withColumn("hash", F.xxhash64("passage"))
    )
    wanted = quotes.select("conv_id", "hash").distinct().withColumnsRenamed({"conv_id": "_conv", "hash": "_hash"})
    own_lines = F.split("text", "\n")
    own_blocks = F.split("text", r"\n\n+")
    pieces = F.array_distinct(F.transform(F.concat(F.array("text"), own_blocks, own_lines), normalised))
    # hashes meet first; only the messages that hold a wanted one are read for its text
    told = rows.filter(F.col("turn").isNotNull())
    hashes = F.transform(F.filter(pieces, lambda p: p != ""), lambda p: F.xxhash64(p))
    holding = (
        told.select("row", "conv_id", F.explode(hashes).alias("hash"))
        .join(wanted, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("hash") == F.col("_hash")), "left_semi")
        .select(F.col("row").alias("_row"), F.col("hash").alias("_want"))
    )
    held = told.select("row", "conv_id", "turn", "text").join(holding, F.col("row") == F.col("_row"))
    originals = cut(
        held.select("conv_id", "turn", F.col("_want").alias("hash"), F.explode(F.filter(pieces, lambda p: F.xxhash64(p) == F.col("_want"))).alias("passage"))
        .filter("passage <> ''")
    )
    linked = latest_before(quotes, originals, ["conv_id", "hash", "passage"], "turn")
    best = F.min(F.when(F.col("found").isNotNull(), F.struct("level", "at", "found")))
    answers = linked.groupBy("row").agg(best["found"].alias("reply_to"), F.count("*").alias("n_quotes"), F.count("found").alias("n_linked"))
    replies = rows.drop("quotes").join(answers.withColumnRenamed("row", "_row"), F.col("row") == F.col("_row"), "left").drop("_row")
    # a turn's thread: its lowest reply target stands for repeated rows of one turn
    hops = rows.select("conv_id", "turn", "row").join(answers.select(F.col("row").alias("_row"), "reply_to"), F.col("row") == F.col("_row"))
    hops = cut(hops.filter("reply_to is not null").groupBy("conv_id", "turn").agg(F.min("reply_to").alias("root")))
    while True:
        up = hops.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.col("root").alias("_up"))
        jumped = cut(
            hops.join(up, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("root") == F.col("_t")), "left")
            .select("conv_id", "turn", F.coalesce("_up", "root").alias("root"), F.col("_up").isNotNull().alias("moved"))
        )
        hops = jumped.drop("moved")
        if jumped.filter("moved").isEmpty():
            break
    threads = hops.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), "root")
    threaded = replies.join(threads, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("turn") == F.col("_t")), "left")
    threaded = threaded.withColumn("root_turn", F.coalesce("root", "turn")).drop("_c", "_t", "root")
    threaded = threaded.withColumn("_tie", F.xxhash64("text", "role"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "root_turn", "turn", "_tie", "row")]
    placed = numbered(threaded, order)
    starts = placed.groupBy(F.col("conv_id").alias("_conv")).agg(F.min("at").alias("_start"))
    return placed.join(starts, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", "turn", "role", "reply_to", "root_turn", (F.col("at") - F.col("_start")).alias("position"), "quote_levels",
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "text",
    )


def formatted(linked: DataFrame) -> DataFrame:
    """``linked`` with ``turn_text``: the message in chat markup."""
    return linked.withColumn(
        "turn_text", F.concat(F.lit("<|"), F.coalesce("role", F.lit("user")), F.lit("|>\n"), F.col("text"), F.lit("\n"))
    )
