"""Chat formatting: layouts told apart by schema fingerprints.

Records of many layouts (prompt and response, instruction and input, lists of
messages, one row a turn) arrive in one table with the union of their nested
fields, as Spark reads mixed JSON.  A record's fingerprint is the hash of the
sorted paths of known fields that it fills.  Fingerprints select a declarative
mapping, which turns the record into canonical turns ``(role, text)``.

A template marks the turns and escapes control strings inside roles and texts,
so that no text can open or close a turn, and the reader gets every character
back.  The loss mask covers the assistants' texts as byte ranges of the output.

Only native expressions are used; no Python runs on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starload.llm.common import free_name

# --- layouts -----------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """A declarative mapping.  ``needs`` and ``may`` are leaf paths (``a.b``, and
    ``list[].b`` inside arrays).  ``turns``: (role, text) pairs; a role is
    ``=name`` for a fixed one or else a path, a text is a path or several,
    joined by blank lines.  ``each``: (array path, role field, text field)."""

    name: str
    needs: tuple[str, ...]
    may: tuple[str, ...] = ()
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    each: tuple[str, str, str] | None = None
    roles: dict[str, str] = field(default_factory=dict, hash=False)


#: Names of roles in lists that speak of people and models.
SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

LAYOUTS = (
    Layout("turn_row", (), ("role", "text"), turns=(("role", ("text",)),)),
    Layout("prompt_response", ("prompt",), ("response", "system"),
           turns=(("=system", ("system",)), ("=user", ("prompt",)), ("=assistant", ("response",)))),
    Layout("prompt_completion", ("prompt", "completion"), ("system",),
           turns=(("=system", ("system",)), ("=user", ("prompt",)), ("=assistant", ("completion",)))),
    Layout("instruction", ("instruction",), ("input", "output", "system"),
           turns=(("=system", ("system",)), ("=user", ("instruction", "input")), ("=assistant", ("output",)))),
    Layout("question_answer", ("question",), ("answer",),
           turns=(("=user", ("question",)), ("=assistant", ("answer",)))),
    Layout("messages", ("messages[].role",), ("messages[].content",), each=("messages", "role", "content")),
    Layout("conversations", ("conversations[].from",), ("conversations[].value",),
           each=("conversations", "from", "value"), roles=SPEAKERS),
)


def known_paths(layouts=LAYOUTS) -> list[str]:
    return sorted({p for x in layouts for p in (*x.needs, *x.may)})


def _leaf(df: DataFrame, path: str) -> T.DataType | None:
    """Type of a path's leaf, None if ``df`` has no such path."""
    kind: T.DataType = df.schema
    for step in path.split("."):
        name = step.removesuffix("[]")
        names = {f.name.lower(): f for f in kind.fields} if isinstance(kind, T.StructType) else {}
        if name.lower() not in names:
            return None
        kind = names[name.lower()].dataType
        if step.endswith("[]"):
            if not isinstance(kind, T.ArrayType):
                return None
            kind = kind.elementType
    return None if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else kind


def _quoted(path: str) -> str:
    return ".".join(f"`{p}`" for p in path.split("."))


def _filled(path: str) -> Column:
    """Whether a record fills the path; in arrays, whether any element does."""
    outer, dots, inner = path.partition("[].")
    if dots:
        return F.coalesce(F.exists(F.col(_quoted(outer)), lambda x: x[inner].isNotNull()), F.lit(False))
    return F.col(_quoted(path)).isNotNull()


def fingerprint(df: DataFrame, layouts=LAYOUTS) -> Column:
    """Hash of the sorted known paths that a record fills.  Fields that no
    layout knows are ignored, whatever their names and types are."""
    there = [p for p in known_paths(layouts) if _leaf(df, p) is not None]
    marks = [F.when(_filled(p), F.lit(p)) for p in there]
    return F.xxhash64(F.concat_ws("|", *marks) if marks else F.lit(""))


def fingerprints(spark: SparkSession, df: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """``fp, layout`` for every set of paths that a layout admits and ``df`` can
    hold; of layouts that admit the same set the first counts.  The table has a
    row for each such set, so its size is that of the declarations."""
    sets: dict[str, str] = {}
    for x in layouts:
        if any(_leaf(df, p) is None for p in x.needs):
            continue
        may = [p for p in x.may if _leaf(df, p) is not None]
        if not x.needs and not may:
            continue
        for n in range(len(may) + 1):
            for some in combinations(may, n):
                sets.setdefault("|".join(sorted((*x.needs, *some))), x.name)
    rows = spark.createDataFrame(list(sets.items()), "paths STRING, layout STRING")
    return rows.select(F.xxhash64("paths").alias("fp"), "layout")


_TURNS = "array<struct<role:string,text:string>>"


def _turns(df: DataFrame, x: Layout) -> Column:
    def role_of(c: Column) -> Column:
        named = c
        for old, new in x.roles.items():
            named = F.when(c == old, F.lit(new)).otherwise(named)
        return F.coalesce(named, F.lit(""))

    if x.each:
        path, role, text = x.each
        has_text = _leaf(df, f"{path}[].{text}") is not None
        return F.transform(
            F.col(_quoted(path)),
            lambda e: F.struct(
                role_of(e[role].cast("string")).alias("role"),
                (F.coalesce(e[text].cast("string"), F.lit("")) if has_text else F.lit("")).alias("text"),
            ),
        )
    parts = []
    for role, texts in x.turns:
        have = [F.col(_quoted(p)).cast("string") for p in texts if _leaf(df, p) is not None]
        filled = F.lit(True)
        if role.startswith("="):
            # a fixed turn stands only where one of its fields is filled
            filled = F.coalesce(*have).isNotNull() if have else F.lit(False)
            name = F.lit(role[1:])
        else:
            name = role_of(F.col(_quoted(role)).cast("string")) if _leaf(df, role) is not None else F.lit("")
        text = F.concat_ws("\n\n", *have) if have else F.lit("")
        parts.append(F.when(filled, F.struct(name.alias("role"), text.alias("text"))))
    return F.filter(F.array(*parts), lambda t: t.isNotNull())


def canonical(spark: SparkSession, df: DataFrame, layouts=LAYOUTS) -> DataFrame:
    """``df`` plus ``layout`` and ``turns`` (array of role and text).

    A record whose fingerprint no layout admits keeps its row, with both null.
    Null texts and roles are empty.  If ``df`` has columns of these two names,
    the new ones get underscores.  An empty table stays empty.
    """
    fp, layout, turns = (free_name(df, n) for n in ("_fp", "layout", "turns"))
    found = fingerprints(spark, df, layouts).select(F.col("fp").alias(fp), F.col("layout").alias(layout))
    told = df.withColumn(fp, fingerprint(df, layouts)).join(F.broadcast(found), fp, "left")
    cases = F.lit(None).cast(_TURNS)
    for x in layouts:
        if all(_leaf(df, p) is not None for p in x.needs) and (x.needs or any(_leaf(df, p) for p in x.may)):
            cases = F.when(F.col(layout) == x.name, _turns(df, x).cast(_TURNS)).otherwise(cases)
    return told.withColumn(turns, cases).drop(fp)


# --- template ----------------------------------------------------------------

START, TEXT, END = "<|start|>", "<|text|>", "<|end|>\n"

#: Strings that trainers and servers read as control marks, besides all that
#: begin with ``<|``.  Fixed values.
CONTROLS = ("<s>", "</s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]", "<pad>", "<unk>")

_OPENERS = r"(<(?=\||/?s>|</?SYS>>|pad>|unk>)|\[(?=/?INST\]))"


def escape(text: Column) -> Column:
    """Backslashes are doubled, and one stands after the first character of
    every control string, which is then none any more."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _OPENERS, r"$1\\")


def unescape(text: Column) -> Column:
    """The first of two backslashes goes, and a single one goes."""
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def gather(rows: DataFrame, key: str, order: list[str], turns: str = "turns") -> DataFrame:
    """One formatted conversation for each value of ``key``.

    ``rows`` carry turns in an array column and stand in the order ``order``;
    ties are ordered by role and text, equal rows all stay.  Returns ``key,
    formatted, loss`` (ranges ``start, length`` in bytes).  Each turn is
    formatted and measured before the exchange; a conversation is one value of
    the output and so has to fit one, its rows meet in one task.
    """
    pieces = rows.select(F.col(key).alias("key"), *(F.col(c).alias(f"o{i}") for i, c in enumerate(order)),
                         F.posexplode(turns).alias("at", "turn"))
    body = escape(F.col("turn.text"))
    pieces = pieces.withColumn("head", F.concat(F.lit(START), escape(F.col("turn.role")), F.lit(TEXT)))
    pieces = pieces.withColumn("body", body).select(
        "key", *(f"o{i}" for i in range(len(order))), "at", "head", "body",
        (F.col("turn.role") == "assistant").alias("learn"),
        (F.octet_length("head") + F.octet_length("body") + len(END)).cast("long").alias("size"),
    )
    way = Window.partitionBy("key").orderBy(*(f"o{i}" for i in range(len(order))), "head", "body", "at")
    placed = pieces.withColumn("n", F.row_number().over(way)).withColumn(
        "upto", F.sum("size").over(way.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    piece = F.struct(
        "n", F.concat("head", "body", F.lit(END)).alias("s"), "learn",
        (F.col("upto") - F.octet_length("body") - len(END)).alias("start"),
        F.octet_length("body").cast("long").alias("length"),
    )
    joined = placed.groupBy("key").agg(F.sort_array(F.collect_list(piece)).alias("p"))
    return joined.select(
        F.col("key").alias(key),
        F.array_join(F.transform("p", lambda x: x["s"]), "").alias("formatted"),
        F.transform(
            F.filter("p", lambda x: x["learn"]),
            lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")),
        ).alias("loss"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, unescaped."""
    pieces = F.split(formatted, r"<\|end\|>\n")
    whole = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        halves = F.split(F.substr(piece, F.lit(len(START) + 1)), r"<\|text\|>", 2)
        return F.struct(unescape(halves[0]).alias("role"), unescape(halves[1]).alias("text"))

    return F.transform(whole, turn)


def read_loss(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped, nothing between the ranges."""
    # byte ranges of a binary value are cut without walking over it
    raw = formatted.cast("binary")
    cut = F.transform(
        loss,
        lambda r: unescape(F.substr(raw, (r["start"] + 1).cast("int"), r["length"].cast("int")).cast("string")),
    )
    return F.array_join(cut, "")
