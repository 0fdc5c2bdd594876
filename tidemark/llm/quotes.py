"""Chat formatting by quotation linking, in DataFrame functions alone.

Each message is parsed into runs of lines with the same quote level. Normalised runs, paragraphs,
lines and sentences (across line ends) are hashed; a quoted one is joined to the first message of its conversation that holds
it unquoted. A message answers the earlier message that most of its outermost quote comes from;
messages in a thread follow their turns, so an answer always stands after what it answers.

No step gathers a conversation: first holders are a minimum by (conversation, hash), links are
joins on that key, and threads are found by pointer jumping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import stage

#: Marks at the start of a line, each `>` one level, with blanks between them.
MARKS = r"^((?:[ \t]*>)+)[ \t]?"

#: Between sentences: white space after an end mark, nothing after a wide one, and empty lines.
SENTENCE = r"""(?<=[.!?…]["')\]”’]{0,2})\s+|(?<=[。！？])\s*|\n[ \t]*\n\s*"""


def lines(text: Column) -> Column:
    """array<struct<level, body>> of a text's lines; bodies have lost their quote marks."""
    return F.transform(
        F.split(F.regexp_replace(text, r"\r\n?", "\n"), "\n"),
        lambda l: F.struct(
            F.regexp_count(F.regexp_extract(l, MARKS, 1), F.lit(">")).alias("level"),
            F.regexp_replace(l, MARKS, "").alias("body"),
        ),
    )


def runs(parsed: Column) -> Column:
    """array<struct<level, bodies>>: neighbouring lines of one level, in order."""
    starts = F.filter(
        F.sequence(F.lit(1), F.size(parsed)),
        lambda i: (i == 1) | (F.element_at(parsed, i)["level"] != F.element_at(parsed, F.greatest(i - 1, F.lit(1)))["level"]),
    )

    def run(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get(starts, k + 1), F.size(parsed) + 1)
        part = F.slice(parsed, start, end - start)
        return F.struct(F.element_at(part, 1)["level"].alias("level"), F.transform(part, lambda x: x["body"]).alias("bodies"))

    return F.transform(starts, run)


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _hash(text: Column) -> Column:
    return F.xxhash64(normalised(text))


def _units(bodies: Column) -> Column:
    """array<struct<grain, hash>> of a run: itself (2), its paragraphs (1), its lines (0) and its sentences (-1)."""
    whole = F.array_join(bodies, "\n")
    parts = [F.array(F.struct(F.lit(2).alias("grain"), whole.alias("t")))]
    for grain, cut in ((1, r"\n[ \t]*\n"), (0, r"\n"), (-1, SENTENCE)):
        parts.append(F.transform(F.split(whole, cut), lambda t, g=grain: F.struct(F.lit(g).alias("grain"), t.alias("t"))))
    full = F.filter(F.concat(*parts), lambda u: normalised(u["t"]) != "")
    return F.array_distinct(F.transform(full, lambda u: F.struct(u["grain"].alias("grain"), _hash(u["t"]).alias("hash"))))


def parse(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, own (text without quotes), runs and n_quotes of each message."""
    base = messages.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    quoted = F.col("text").rlike(r"(?m)" + MARKS)
    # a message without quote marks is one run as it stands
    plain = F.array(F.struct(F.lit(0).alias("level"), F.split("text", "\n").alias("bodies")))
    parsed = base.withColumn("runs", F.when(quoted, runs(lines(F.col("text")))).otherwise(plain))
    own = F.trim(F.array_join(F.transform(F.filter("runs", lambda r: r["level"] == 0), lambda r: F.array_join(r["bodies"], "\n")), "\n"), F.lit(" \n\t\r"))
    return parsed.select(
        "conv_id", "turn", "role", F.when(quoted, own).otherwise(F.col("text")).alias("own"), "runs",
        F.size(F.filter("runs", lambda r: r["level"] > 0)).alias("n_quotes"),
        F.xxhash64("role", "text").alias("body_hash"),
    )


def quote_links(parsed: DataFrame) -> DataFrame:
    """conv_id, turn, body_hash, run, level, from_turn: the earlier message each quoted run comes from.

    Whole runs decide before paragraphs, paragraphs before lines, lines before sentences; of several messages the one with
    the most matching parts, then the latest. Runs that match nothing earlier are left out.
    """
    exploded = parsed.select("conv_id", "turn", "body_hash", F.posexplode("runs").alias("run", "r"))
    quotes = exploded.filter("r.level > 0").select(
        "conv_id", "turn", "body_hash", "run", F.col("r.level").alias("level"), F.explode(_units(F.col("r.bodies"))).alias("u")
    )
    quotes = stage(
        quotes.select("conv_id", "turn", "body_hash", "run", "level", F.col("u.grain").alias("grain"), F.col("u.hash").alias("hash")).filter(
            "conv_id IS NOT NULL AND turn IS NOT NULL"
        ),
        "quotes",
    )
    # only hashes that some quote of the conversation asks for are looked up
    asked = quotes.select("conv_id", "hash").distinct()
    holders = (
        exploded.filter("r.level = 0")
        .select("conv_id", "turn", F.explode(_units(F.col("r.bodies"))).alias("u"))
        .select("conv_id", "turn", F.col("u.hash").alias("hash"))
        .join(asked, ["conv_id", "hash"], "left_semi")
        .groupBy("conv_id", "hash")
        .agg(F.min("turn").alias("from_turn"))
    )
    key = ["conv_id", "turn", "body_hash", "run", "level"]
    votes = (
        quotes.join(holders, ["conv_id", "hash"])
        .filter("from_turn < turn")
        .groupBy(*key, "from_turn")
        .agg(F.max("grain").alias("grain"), F.count(F.lit(1)).alias("n"))
    )
    best = F.max(F.struct("grain", "n", "from_turn")).alias("b")
    return votes.groupBy(*key).agg(best).select(*key, F.col("b.from_turn").alias("from_turn"))


def _threads(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, parent) to (conv_id, turn, root, depth) by pointer jumping; parents are earlier."""
    now = stage(parents.select("conv_id", "turn", F.col("parent").alias("root"), F.lit(1).alias("depth")), "threads")
    while True:
        up = now.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("above"), F.col("depth").alias("more"))
        jumped = now.join(up, ["conv_id", "root"], "left")
        if not jumped.filter("above IS NOT NULL").limit(1).count():
            return now
        now = stage(
            jumped.select(
                "conv_id", "turn", F.coalesce("above", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")
            ),
            "threads",
        )


def link_quotes(messages: DataFrame) -> DataFrame:
    """One row for each message: conv_id, turn, role, text, n_quotes, n_linked, parent_turn, thread_turn, depth.

    text is the message without quoted lines, trimmed if it had any. n_quotes counts its quoted
    runs, n_linked those found in earlier messages, parent_turn the message that its first
    outermost linked run comes from (null: none). thread_turn is the first message of its thread
    (its own turn for one that answers none) and depth the number of answers in between. Ordered
    by (conv_id, thread_turn, turn) every answer follows what it answers. A null text is empty; a
    message with a null conv_id or turn is never linked; rows that repeat a turn are parsed one
    by one and share the turn's parent, the earliest of theirs. An empty table gives no rows.
    """
    parsed = parse(messages)
    links = stage(quote_links(parsed), "links")
    first = links.groupBy("conv_id", "turn", "body_hash").agg(
        F.count(F.lit(1)).cast("int").alias("n_linked"), F.min(F.struct("level", "run", "from_turn")).alias("f")
    )
    first = first.select("conv_id", "turn", "body_hash", "n_linked", F.col("f.from_turn").alias("from_turn"))
    parents = first.groupBy("conv_id", "turn").agg(F.min("from_turn").alias("parent"))
    threads = _threads(parents)
    linked = first.join(parents, ["conv_id", "turn"]).join(threads, ["conv_id", "turn"])
    same = ["conv_id", "turn", "body_hash"]
    return (
        parsed.drop("runs")
        .join(linked, same, "left")
        .select(
            "conv_id", "turn", "role", F.col("own").alias("text"), "n_quotes",
            F.coalesce("n_linked", F.lit(0)).alias("n_linked"), F.col("parent").alias("parent_turn"),
            F.coalesce("root", "turn").alias("thread_turn"), F.coalesce("depth", F.lit(0)).alias("depth"),
        )
    )
