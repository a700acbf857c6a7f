"""Chat formatting with typed content parts, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Content parts of a turn, in order. Sizes that a kind does not use stay null.
PART = "struct<kind:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: A text is changed only where "<" or "[" stands before backslashes, if any, and one of these tails: every control
#: string of this template, and those of two public templates, starts so. Tails hold no "<" and no "[".
_HIDE = [("<", r"\||/?s>"), (r"\[", r"/?INST\]")]


def escape(text: Column) -> Column:
    """Puts a backslash after the first character of each control string, and one more where some stand there already."""
    for head, tails in _HIDE:
        text = F.regexp_replace(text, rf"({head})(\\*(?:{tails}))", r"$1\\$2")
    return text


def unescape(text: Column) -> Column:
    """The exact inverse of escape()."""
    for head, tails in _HIDE:
        text = F.regexp_replace(text, rf"({head})\\(\\*(?:{tails}))", "$1$2")
    return text


@dataclass(frozen=True)
class PartVisitor:
    """What each kind of part becomes: (formatted text, expanded tokens). Tokens of text are left to the tokenizer (0).
    Image tokens: patches of `patch` pixels a side. Audio: `audio_rate` a second. Documents: `page_tokens` a page."""

    patch: int = 14
    audio_rate: float = 25.0
    page_tokens: int = 512
    more: dict[str, Callable[[Column], tuple[Column, Column]]] = field(default_factory=dict)

    def text(self, p: Column) -> tuple[Column, Column]:
        return escape(F.coalesce(p["text"], F.lit(""))), F.lit(0).cast("long")

    def image(self, p: Column) -> tuple[Column, Column]:
        side = lambda x: F.ceil(F.coalesce(x, F.lit(0)) / F.lit(self.patch)).cast("long")
        return F.lit("<|image|>"), side(p["width"]) * side(p["height"])

    def audio(self, p: Column) -> tuple[Column, Column]:
        return F.lit("<|audio|>"), F.ceil(F.coalesce(p["seconds"], F.lit(0.0)) * F.lit(self.audio_rate)).cast("long")

    def document(self, p: Column) -> tuple[Column, Column]:
        return F.lit("<|document|>"), (F.coalesce(p["pages"], F.lit(0)) * F.lit(self.page_tokens)).cast("long")

    def visit(self, p: Column) -> Column:
        """A part's struct (out, tokens, attached). An unknown or null kind is taken as text."""
        kinds = {"image": self.image, "audio": self.audio, "document": self.document} | self.more
        out, tokens = self.text(p)
        for kind, f in kinds.items():
            o, t = f(p)
            out, tokens = F.when(p["kind"] == kind, o).otherwise(out), F.when(p["kind"] == kind, t).otherwise(tokens)
        return F.struct(out.alias("out"), tokens.alias("tokens"), F.coalesce(p["kind"].isin(*kinds), F.lit(False)).alias("attached"), p["kind"].alias("kind"), p["ref"].alias("ref"))


def format_chats(turns: DataFrame, visitor: PartVisitor | None = None, trained_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Formats conversations from rows (conv_id, turn, role, parts), parts an array of PART.

    Returns a row for each conv_id: n_turns, formatted, loss_spans (array of start, length in code points: the
    texts of trained roles, placeholders left out), attachments (array of ordinal, turn_no, kind, ref, tokens, in
    order), expanded_tokens. A turn is <|turn|>role<|text|>content<|end|>; role and texts are escaped reversibly,
    so no text can close a turn or open one.

    Turns are ordered by turn, then role, then content; nulls first. Repeated rows are turns of their own. Null
    role or text: empty. No parts: an empty turn. A null conv_id is one conversation. No rows: no rows.
    A conversation is one value, so it meets in one task; one shuffle by conv_id serves the running offsets and
    the collecting.
    """
    visitor = visitor or PartVisitor()
    role = F.coalesce(F.col("role"), F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), F.coalesce(F.col("parts"), F.array().cast(f"array<{PART}>")).alias("parts"))
    rows = rows.select("conv_id", "turn", "role", F.transform("parts", visitor.visit).alias("seen"))
    rows = rows.select(
        "conv_id", "turn", "role", F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT)).alias("head"),
        F.array_join(F.transform("seen", lambda p: p["out"]), "").alias("body"), "seen", F.col("role").isin(*trained_roles).alias("trained"),
    )
    order = "PARTITION BY conv_id ORDER BY turn, role, body"
    rows = rows.withColumn("long", F.char_length("head") + F.char_length("body") + F.lit(len(END)))
    rows = rows.selectExpr("*", f"sum(long) OVER ({order} ROWS UNBOUNDED PRECEDING) - long AS at", f"row_number() OVER ({order}) - 1 AS no")
    start = F.col("at") + F.char_length("head")
    # the parts' own offsets inside the turn: a fold over the (few) parts of one turn
    spans = F.aggregate(
        "seen",
        F.struct(start.cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("got")),
        lambda acc, p: F.struct(
            (acc["at"] + F.char_length(p["out"])).cast("long").alias("at"),
            F.when(p["attached"] | (F.char_length(p["out"]) == 0), acc["got"]).otherwise(
                F.concat(acc["got"], F.array(F.struct(acc["at"].alias("start"), F.char_length(p["out"]).cast("long").alias("length"))))
            ).alias("got"),
        ),
        lambda acc: acc["got"],
    )
    kept = F.transform(F.filter("seen", lambda p: p["attached"]), lambda p: F.struct(F.col("no").alias("turn_no"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens")))
    rows = rows.select(
        "conv_id", "no", F.concat("head", "body", F.lit(END)).alias("out"), kept.alias("kept"),
        F.when(F.col("trained"), spans).otherwise(F.array().cast("array<struct<start:bigint,length:bigint>>")).alias("spans"),
    )
    got = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("no", "out", "spans", "kept"))).alias("t"))
    attachments = F.flatten(F.transform("t", lambda x: x["kept"]))
    return got.select(
        "conv_id", F.size("t").cast("long").alias("n_turns"), F.array_join(F.transform("t", lambda x: x["out"]), "").alias("formatted"),
        F.flatten(F.transform("t", lambda x: x["spans"])).alias("loss_spans"),
        F.transform(attachments, lambda a, i: F.struct(i.alias("ordinal"), a["turn_no"].alias("turn_no"), a["kind"].alias("kind"), a["ref"].alias("ref"), a["tokens"].alias("tokens"))).alias("attachments"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda s, a: s + a["tokens"]).alias("expanded_tokens"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of (role, text), unescaped; placeholders stay in the text."""
    cut = F.filter(F.split(formatted, r"<\|turn\|>"), lambda x: x != "")
    parts = lambda x: F.split(F.regexp_replace(x, r"<\|end\|>$", ""), r"<\|text\|>", 2)
    return F.transform(cut, lambda x: F.struct(unescape(parts(x)[0]).alias("role"), unescape(F.get(parts(x), F.lit(1))).alias("text")))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped. Fixed-width code points make each span a plain slice; the text is put into that form
    once (as the bound variable of a one-element transform), however many spans there are. Texts of over 2^29 code points do not fit."""
    def cut(wide: Column) -> Column:
        one = lambda s: F.decode(F.substring(wide, (s["start"] * 4 + 1).cast("int"), (s["length"] * 4).cast("int")), "UTF-32")
        return F.array_join(F.transform(spans, lambda s: unescape(one(s))), "")

    return F.get(F.transform(F.array(F.encode(formatted, "UTF-32")), cut), F.lit(0))


def from_rows(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with the text as the only part; all other columns are left behind."""
    part = F.struct(
        F.lit("text").alias("kind"), F.coalesce(F.col("text"), F.lit("")).alias("text"), F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("width"),
        F.lit(None).cast("int").alias("height"), F.lit(None).cast("double").alias("seconds"), F.lit(None).cast("int").alias("pages"),
    )
    return conversations.select("conv_id", "turn", "role", F.array(part).alias("parts"))


def digest(formatted: DataFrame) -> DataFrame:
    """What is read back from format_chats(): counts and hashes of turns and of the text under the mask."""
    one = F.array_join(F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = formatted.select(
        "conv_id", "attachments", "expanded_tokens", F.size(read_turns(F.col("formatted"))).cast("long").alias("n_turns"), F.sha2(one, 256).alias("turns_sha256"),
        masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"), F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
    return read.select(
        "conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars",
        F.size("attachments").cast("long").alias("n_attachments"), "expanded_tokens",
    )


SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(text) + len(regexp_extract_all(text, '<\\*(\||/?s>)')) + len(regexp_extract_all(text, '\[\\*/?INST\]')) AS n,
  length(role) + len(regexp_extract_all(role, '<\\*(\||/?s>)')) + len(regexp_extract_all(role, '\[\\*/?INST\]')) AS m FROM c)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(8 + 8 + 7 + n + m)::BIGINT AS formatted_chars, 0::BIGINT AS n_attachments, 0::BIGINT AS expanded_tokens
FROM e GROUP BY conv_id
"""
