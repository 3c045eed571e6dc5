"""Chat formatting with a grammar round trip; DataFrame expressions only.

A turn is written ``### Role: text</turn>`` and a line feed.  The parser is deterministic: it
cuts at ``</turn>``, takes the role up to the first ``: `` and the text after it, refuses a text
that holds a header mark, and reads a backslash as "the next character as it is".

Each turn is written plainly first and parsed back.  Where the recovered turn differs from its
source, its control strings are escaped: a backslash goes before every backslash, into
``</turn>`` and into the header mark.  The escaped form is parsed again, and a turn that still
differed would stop the job, as would a conversation that differs as a whole.

The output is a row a conversation: ``segments``, whose texts joined are the formatted
conversation, each with ``loss`` true for what an assistant says.  Turns are written out and
checked before they are gathered by conversation.

Defined results: a null text or role is empty; turns stand by number, and turns of one number by
role and text (null numbers first); rows with a null ``conv_id`` form one conversation; repeated turns
all stay; very long texts are written whole; no turns give no rows; columns beside the four named are
not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the grammar.
HEAD, COLON, END, NEXT = "### ", ": ", "</turn>", "\n"
ASSISTANT = "assistant"


def escape_text(text: Column) -> Column:
    """A backslash before every backslash and inside every control string."""
    return F.regexp_replace(text, r"(?=\\)|(?<=<)(?=/turn>)|(?<=#)(?=## )", r"\\")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(escape_text(role), r"(?<=:)(?= )|(?=\n)", r"\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def header(role: Column) -> Column:
    """Roles are written with a capital where lower-casing gives the source back."""
    shown = F.initcap(role)
    return F.concat(F.lit(HEAD), F.when((F.lower(shown) == role) & ~F.startswith(role, F.lit("=")), shown).otherwise(F.concat(F.lit("="), role)),
                    F.lit(COLON))


def parse_turn(piece: Column) -> Column:
    """struct(role, text) of the piece before a turn's end mark; null if it breaks the grammar."""
    colon = F.instr(piece, COLON)
    shown = F.substring(piece, F.lit(len(HEAD) + 1), colon - len(HEAD) - 1)
    role = F.when(F.startswith(shown, F.lit("=")), unescape(F.substr(shown, F.lit(2)))).otherwise(
        F.lower(unescape(shown)))
    body = F.substr(piece, colon + len(COLON))
    sound = F.startswith(piece, F.lit(HEAD)) & (colon > len(HEAD)) & ~F.contains(body, F.lit(HEAD))
    return F.when(sound, F.struct(role.alias("role"), unescape(body).alias("text")))


def pieces(formatted: Column) -> Column:
    """Parts before each end mark, without the line feed that follows the mark before."""
    cut = F.split(formatted, END)
    return F.transform(F.slice(cut, 1, F.size(cut) - 1),
                       lambda p, i: F.when(i == 0, p).otherwise(F.substr(p, F.lit(1 + len(NEXT)))))


def parse(formatted: Column) -> Column:
    """array<struct(role, text)> of a formatted conversation."""
    return F.transform(pieces(formatted), parse_turn)


def _written(role: Column, text: Column) -> Column:
    return F.struct(header(role).alias("head"), text.alias("body"))


def _same(written: Column, role: Column, text: Column) -> Column:
    """Whether a written turn, with its end mark, parses to just its source."""
    whole = F.concat(written["head"], written["body"], F.lit(END + NEXT))
    back = parse(whole)
    return F.coalesce((F.size(back) == 1) & (back[0] == F.struct(role.alias("role"), text.alias("text"))), F.lit(False))


def render_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with ``head`` and ``body`` of each turn's written form."""
    role, text = F.col("role"), F.col("text")
    plain = _written(role, text)
    escaped = _written(escape_role(role), escape_text(text))
    tried = turns.withColumn("w", F.when(_same(plain, role, text), plain).when(_same(escaped, role, text), escaped)
                             .otherwise(F.raise_error(F.lit("a turn does not survive the round trip"))))
    return tried.select("conv_id", "turn", "role", "text", F.col("w.head").alias("head"), F.col("w.body").alias("body"))


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``conv_id, n_turns, segments`` with ``segments`` array<struct(text, loss)>."""
    turns = rows.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    one = F.struct("turn", "role", "text", "head", "body")
    convs = render_turns(turns).groupBy("conv_id").agg(F.array_sort(F.collect_list(one)).alias("t"))
    cut = F.flatten(F.transform("t", lambda x: F.array(
        F.struct(x["head"].alias("text"), F.lit(False).alias("loss")),
        F.struct(x["body"].alias("text"), (x["role"] == ASSISTANT).alias("loss")),
        F.struct(F.lit(END + NEXT).alias("text"), F.lit(False).alias("loss")))))
    source = F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    convs = convs.select("conv_id", F.size("t").cast("long").alias("n_turns"), cut.alias("segments"), source.alias("source"))
    sound = F.coalesce(parse(formatted(F.col("segments"))) == F.col("source"), F.lit(False))
    return convs.select("conv_id", "n_turns", F.when(sound, F.col("segments")).otherwise(
        F.raise_error(F.lit("a conversation does not survive the round trip"))).alias("segments"))


def formatted(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
