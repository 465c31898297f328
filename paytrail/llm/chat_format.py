"""Chat conversations as training windows, with column functions only.

Prefix sums of the tokens of a conversation's turns choose spans that begin and end with a turn.
Each window retains the system turn, repeats a limited stretch of the turns before its span, and
has a loss mask over the assistant texts of the span alone, so a repeated target counts once.
The template marks every turn; control strings inside a text get a backslash, which goes again
when the text is read back.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytrail.llm.common import store
from paytrail.llm.ordered import in_order

#: Tokens of a window and of the history it repeats, and least room for its span.
BUDGET = 1024
HISTORY = 128
LEAST_ROOM = 128
#: Pairs of half-rooms that share one copy of the system turn on the way to their windows.
SYSTEM_SHARE = 64

BEGIN = "<s>"
#: Marks around a text by role. Any other role is written out between ROLE and TEXT.
MARKS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("[OUT] ", " </s>")}
ROLE, TEXT, END = "[ROLE] ", " [TEXT] ", " [/ROLE]"
#: What follows the bracket of a control string.
_TAILS = r"/?s>|/?SYS\]|/?INST\]|OUT\]|/?ROLE\]|TEXT\]"
_OPEN = r"(?=\[(?:SYS|INST|OUT|ROLE)\] )"
#: Estimate of tokens, as tokenizers are no column functions: up to five letters, three digits or one sign each.
_TOKEN = r"\p{L}{1,5}|\p{N}{1,3}|[^\t-\r \p{L}\p{N}]"
MARK_TOKENS = 2


def escape(text: Column) -> Column:
    """A backslash behind the bracket of each control string, in front of those already there."""
    return F.regexp_replace(text, rf"([<\[])(\\*)(?={_TAILS})", r"$1$2\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)(?={_TAILS})", "$1$2")


def tokens(text: Column) -> Column:
    """Tokens of a turn with its marks, estimated."""
    return (F.regexp_count(text, F.lit(_TOKEN)) + MARK_TOKENS).cast("long")


def formatted(role: Column, text: Column) -> Column:
    """One turn between its marks."""
    other = F.concat(F.lit(ROLE), escape(role), F.lit(TEXT), escape(text), F.lit(END))
    return reduce(
        lambda rest, m: F.when(role == m[0], F.concat(F.lit(m[1][0]), escape(text), F.lit(m[1][1]))).otherwise(rest),
        MARKS.items(), other,
    )


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, kind, sign, cost, piece): each turn formatted where it lies.

    kind is the role if it has marks of its own, else ``other``; sign tells turns of one number apart.
    """
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(role.isin(*MARKS), role).otherwise("other").alias("kind"),
        F.xxhash64(role, text).alias("sign"), tokens(text).alias("cost"), formatted(role, text).alias("piece"),
        F.monotonically_increasing_id().alias("row"),
    )


def laid_out(rows: DataFrame, budget: int, history: int) -> DataFrame:
    """(row, first, rank, total, opening, room, back) of each turn, without any text.

    first and total are the tokens before the turn and of its conversation; opening those of the
    system turn, if the first turn is one; room is left for a span, back for the history.
    """
    slim = store(rows.drop("piece"), "chat-turns")
    placed = in_order(slim, ["conv_id"], ["turn", "sign"], F.col("cost"), "chat-order")
    placed = store(placed.select(
        "conv_id", "row", "kind", "cost", F.col("_before").alias("first"), F.col("_rank").alias("rank"),
        F.col("_sum").alias("total"),
    ), "chat-placed")
    # Only conversations longer than a window need to know their system turn.
    openings = placed.where((F.col("rank") == 0) & (F.col("kind") == "system") & (F.col("total") > budget)).select(
        F.col("conv_id").alias("conv"), F.col("cost").alias("opening")
    )
    same = F.col("conv_id").eqNullSafe(F.col("conv"))
    opening = F.coalesce("opening", F.lit(0)).cast("long")
    # A conversation within the budget is one window, whatever its turns are.
    room = F.when(F.col("total") <= budget, F.lit(budget)).otherwise(
        F.greatest(F.lit(LEAST_ROOM), F.lit(budget - history) - opening)
    ).cast("long")
    return placed.join(openings, same, "left").select(
        "row", "first", "rank", "total", opening.alias("opening"), room.alias("room"),
        F.least(F.lit(history).cast("long"), F.floor(room / 2)).alias("back"),
    )


def _loss(lead: Column, turns_: Column, upto: Column) -> Column:
    """(start, length), in code points, of the new assistant texts in a window.

    ``lead`` is the length in front of ``turns_``; the first ``upto`` turns are repeated.
    """
    before, behind = (len(m) for m in MARKS["assistant"])

    def step(state, turn):
        size = F.length(turn["piece"])
        span = F.struct(
            (state["at"] + before).cast("int").alias("start"), (size - (before + behind)).cast("int").alias("length")
        )
        new = (turn["kind"] == "assistant") & (state["seen"] >= upto)
        return F.struct(
            (state["at"] + size).cast("int").alias("at"), (state["seen"] + 1).cast("int").alias("seen"),
            F.when(new, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"),
        )

    empty = F.array().cast("array<struct<start:int,length:int>>")
    zero = F.struct(lead.cast("int").alias("at"), F.lit(0).cast("int").alias("seen"), empty.alias("spans"))
    return F.aggregate(turns_, zero, step, lambda state: state["spans"])


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """Training windows of all ``conversations`` (conv_id, turn, role, text).

    Rows (conv_id, window, whole, text, repeated, loss): ``window`` counts the tokens of the
    conversation before the window's first new turn; ``whole`` says that it is the only one; ``repeated``
    is how many turns at its beginning, the system turn among them, stood in a window before;
    ``loss`` has the (start, length) of the texts to learn, in code points of ``text``.

    Turns follow their number, null first; turns of one number follow a hash of role and
    text, and repeated rows are turns of their own. Null roles and texts count as empty. Rows
    without a conv_id are one conversation. The first turn is kept in all windows if its role
    is ``system``. An empty table gives no windows; other columns are not looked at.

    Spans are the turns that begin within a stretch as long as the room, halved if they do not fit.
    So a window is over the budget only if one turn is longer than half of the room, or
    the system turn leaves less than LEAST_ROOM; texts are never cut.
    """
    rows = store(turns(conversations), "chat-rows")
    plan = store(laid_out(rows, budget, history), "chat-plan")
    stretch = F.floor(F.col("first") / F.col("room")).cast("long")
    # A turn near the end of its stretch may be history of the next; only those go there as well.
    late = (F.col("first") >= (stretch + 1) * F.col("room") - F.col("back")) & (F.col("total") > F.col("room"))
    there = F.when(late, F.array(stretch, stretch + 1)).otherwise(F.array(stretch))
    joined = rows.select("row", "conv_id", "kind", "cost", "piece").join(plan, "row")
    spread = joined.withColumn("own", stretch).withColumn("stretch", F.explode(there))
    turn = F.struct("first", "rank", "cost", "kind", "piece", (F.col("own") == F.col("stretch")).alias("own"))
    # Stored, as both branches below read it: texts move twice, to their plan and to their stretch.
    gathered = store(spread.groupBy("conv_id", "stretch", "room", "back", "opening", "total").agg(
        F.sort_array(F.collect_list(turn)).alias("turns")
    ), "chat-gathered")
    later = gathered.where((F.col("stretch") > 0) & (F.col("opening") > 0))
    # The system turn reaches its windows in shares, so a long conversation is not one key.
    first = F.get("turns", F.lit(0))
    openings = gathered.where((F.col("stretch") == 0) & (F.col("opening") > 0)).select(
        F.col("conv_id").alias("conv"), first["piece"].alias("system"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("total") / F.col("room") / SYSTEM_SHARE))).alias("share"),
    )
    same = F.col("conv_id").eqNullSafe(F.col("conv")) & (F.floor(F.col("stretch") / SYSTEM_SHARE) == F.col("share"))
    headed = later.join(openings, same).select(*gathered.columns, "system")
    plain = gathered.where((F.col("stretch") == 0) | (F.col("opening") == 0)).withColumn(
        "system", F.when(F.col("opening") > 0, first["piece"])
    )
    return _cut(headed.unionByName(plain))


def _cut(groups: DataFrame) -> DataFrame:
    """The one or two windows of each stretch."""
    own = F.filter("turns", lambda t: t["own"])
    groups = groups.withColumn("new", own).where(F.size("new") > 0)
    last = F.try_element_at("new", F.lit(-1))
    fits = last["first"] + last["cost"] - F.get("new", F.lit(0))["first"] <= F.col("room")
    middle = F.col("stretch") * F.col("room") + F.floor(F.col("room") / 2)
    halves = F.array(
        F.filter("new", lambda t: t["first"] < middle), F.filter("new", lambda t: t["first"] >= middle)
    )
    spans = F.when(fits, F.array("new")).otherwise(F.filter(halves, lambda h: F.size(h) > 0))
    cut = groups.withColumn("spans", spans).withColumn("span", F.explode("spans")).withColumn(
        "window", F.get("span", F.lit(0))["first"]
    )
    # The system turn is put in front, so it is not history as well.
    known = F.greatest(F.col("window") - F.col("back"), F.col("opening"))
    past = F.filter("turns", lambda t: (t["first"] < F.col("window")) & (t["first"] >= known))
    again = (F.col("window") > 0) & F.col("system").isNotNull()
    body = cut.withColumn("past", past).withColumn("system", F.when(again, F.col("system"))).withColumn(
        "said", F.concat("past", "span")
    )
    head = F.concat(F.lit(BEGIN), F.coalesce("system", F.lit("")))
    return body.select(
        "conv_id", "window",
        ((F.col("window") == 0) & (last["first"] + last["cost"] == F.col("total")) & (F.size("spans") == 1)).alias("whole"),
        F.concat(head, F.array_join(F.transform("said", lambda t: t["piece"]), "")).alias("text"),
        (F.size("past") + F.col("system").isNotNull().cast("int")).alias("repeated"),
        _loss(F.length(head), F.col("said"), F.size("past")).alias("loss"),
    )


def _between(piece: Column, before: str, behind: str) -> Column:
    return F.substring(piece, F.lit(len(before) + 1), F.length(piece) - (len(before) + len(behind)))


def _read_turn(piece: Column) -> Column:
    """(role, text) of one formatted turn."""
    parts = F.split(_between(piece, ROLE, END), r" \[TEXT\] ", 2)
    other = F.struct(unescape(F.get(parts, F.lit(0))).alias("role"), unescape(F.get(parts, F.lit(1))).alias("text"))
    return reduce(
        lambda rest, m: F.when(
            F.startswith(piece, F.lit(m[1][0])),
            F.struct(F.lit(m[0]).alias("role"), unescape(_between(piece, *m[1])).alias("text")),
        ).otherwise(rest), MARKS.items(), other,
    )


def read_turns(text: Column) -> Column:
    """Array of (role, text): the turns of a window, from its text alone."""
    pieces = F.split(text, _OPEN)
    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), _read_turn)


def read_loss(text: Column, loss: Column) -> Column:
    """All text under the loss mask of a window."""
    return F.array_join(F.transform(
        loss, lambda span: unescape(F.substring(text, span["start"] + 1, span["length"]))
    ), "")


def read_back(formatted_windows: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from windows.

    Turns that a window repeats are left out. Only conversations of several windows are gathered;
    the digest of one needs all its text in one value, so it must fit in one.
    """
    new = F.slice("turns", F.col("repeated") + 1, F.size("turns"))
    lines = F.transform(new, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = formatted_windows.withColumn("turns", read_turns(F.col("text"))).select(
        "conv_id", "window", "whole", F.size(new).cast("long").alias("n"), F.array_join(lines, "").alias("said"),
        read_loss(F.col("text"), F.col("loss")).alias("learned"), F.length("text").cast("long").alias("chars"),
    )
    several = read.where(~F.col("whole")).groupBy("conv_id").agg(
        F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("window", "said", "learned"))).alias("all"),
        F.sum("chars").alias("chars"),
    ).select(
        "conv_id", "n", F.array_join("all.said", "").alias("said"), F.array_join("all.learned", "").alias("learned"), "chars"
    )
    return read.where("whole").select(*several.columns).unionByName(several).select(
        "conv_id", F.col("n").alias("n_turns"), F.sha2("said", 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.col("chars").alias("formatted_chars"),
    )
