"""Chat formatting from event logs (DataFrame / SQL only).

A log has events (conv_id, turn, seq, kind, role, text); a turn is a slot of
the conversation and seq orders the events of a conversation:

* ``message`` begins a new message in its slot,
* ``delta`` appends its text to the slot's latest message (or begins one),
* ``edit`` replaces the text of that message so far; later deltas append,
* ``regenerate`` clears it like an edit, and every message of a later slot
  whose last event came before goes, as its context no longer exists.

Events are grouped by (conversation, slot) first, so that the slots of one
very long conversation fold in many tasks, and the folded messages are then
gathered per conversation, which is one output value.  Folding slices the
sorted events; no step is quadratic in a message's deltas.

Template: ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line feed per
message.  Backslashes in roles and texts are doubled and ``<|`` becomes
``<\\|``; no control string can occur inside, and each backslash protects
exactly one character, so ``parse`` restores every text.  The loss mask
covers the texts of messages with the role ``assistant``.

Defined cases: null text and null role are empty; a null turn comes first;
null conversation ids form one conversation; ties in seq are ordered by
kind, role and text; repeated ``message`` events are repeated messages; an
unknown kind counts as ``message``.  An empty log gives no conversations.
Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
LOSS_ROLE = "assistant"


def _sql(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def escape(x: str) -> str:
    """SQL: a text in which no control string occurs."""
    return f"replace(replace({x}, {_sql(chr(92))}, {_sql(chr(92) * 2)}), '<|', {_sql('<' + chr(92) + '|')})"


def unescape(x: str) -> str:
    """SQL: the inverse of ``escape``."""
    return f"regexp_replace({x}, r'(?s)\\\\(.)', '$1')"


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, messages: array of (role, text)) after all events."""
    slots = (events.select("conv_id", "turn", "seq", F.coalesce("kind", F.lit("message")).alias("kind"), "role",
                           F.coalesce("text", F.lit("")).alias("text"))
             .groupBy("conv_id", "turn")
             .agg(F.sort_array(F.collect_list(F.struct("seq", "kind", "role", "text"))).alias("ev"),
                  F.expr("max(seq) FILTER (WHERE kind = 'regenerate')").alias("regen")))
    slots = (slots
             .withColumn("at", F.expr("""filter(transform(ev, (e, i) -> if(i = 0
                 OR e.kind NOT IN ('delta', 'edit', 'regenerate'), i, -1)), i -> i >= 0)"""))
             .withColumn("parts", F.expr("""transform(at, (s, k) -> slice(ev, s + 1,
                 if(k = size(at) - 1, size(ev), at[least(k + 1, size(at) - 1)]) - s))"""))
             .withColumn("messages", F.expr("""transform(transform(parts, p -> struct(p AS p,
                     greatest(0, array_max(transform(p, (e, i) -> if(e.kind IN ('edit', 'regenerate'), i, 0)))) AS c)),
                 x -> struct(
                     coalesce(get(filter(x.p, e -> e.role IS NOT NULL), 0).role, '') AS role,
                     array_join(transform(slice(x.p, x.c + 1, size(x.p)), e -> e.text), '') AS text,
                     array_max(transform(x.p, e -> e.seq)) AS last))""")))
    return (slots.groupBy("conv_id")
            .agg(F.sort_array(F.collect_list(F.struct("turn", "regen", "messages"))).alias("slots"))
            .withColumn("redone", F.expr("filter(slots, s -> s.regen IS NOT NULL)"))
            .selectExpr("conv_id", """flatten(transform(slots, s -> transform(
                if(size(redone) = 0, s.messages, filter(s.messages, m -> NOT exists(redone, r ->
                    coalesce(r.turn < s.turn AND r.regen > m.last, false)))),
                m -> struct(m.role AS role, m.text AS text)))) AS messages"""))


def render(conversations: DataFrame) -> DataFrame:
    """(conv_id, formatted) from (conv_id, messages)."""
    return conversations.selectExpr("conv_id", f"""array_join(transform(messages, m -> concat(
        {_sql(START)}, {escape('m.role')}, {_sql(SEP)}, {escape('m.text')}, {_sql(END)})), '') AS formatted""")


def parse(formatted: DataFrame) -> DataFrame:
    """Adds ``turns``: array of (role, text) read back from the output."""
    start, sep, end = (_sql("\\Q" + x + "\\E") for x in (START, SEP, END))
    return formatted.withColumn("turns", F.expr(f"""
        transform(filter(split(formatted, {end}), x -> x <> ''), x -> struct(
            {unescape(f"split(split(x, {sep})[0], {start})[1]")} AS role,
            {unescape(f"split(x, {sep})[1]")} AS text))"""))


def format_chats(events: DataFrame) -> DataFrame:
    """(conv_id, formatted) of an event log."""
    return render(fold_events(events))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digest columns of formatted conversations, from the output alone."""
    parsed = parse(formatted).withColumn(
        "loss", F.expr(f"array_join(transform(filter(turns, t -> t.role = '{LOSS_ROLE}'), t -> t.text), '')"))
    return parsed.selectExpr(
        "conv_id", "cast(size(turns) AS bigint) AS n_turns",
        r"sha2(array_join(transform(turns, t -> concat(t.role, '\n', t.text, '\n')), ''), 256) AS turns_sha256",
        "cast(char_length(loss) AS bigint) AS loss_chars", "sha2(loss, 256) AS loss_sha256",
        "cast(char_length(formatted) AS bigint) AS formatted_chars")


def message_events(messages: DataFrame) -> DataFrame:
    """Event log of a table of whole messages (conv_id, turn, role, text)."""
    return messages.selectExpr("conv_id", "turn", "cast(turn AS bigint) AS seq", "'message' AS kind", "role", "text")
