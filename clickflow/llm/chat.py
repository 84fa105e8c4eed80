"""Chat formatting (DataFrame functions only).

Records come in many layouts: rows by turn, message lists, role/value lists, prompts with
responses, instructions with inputs. A layout (``LAYOUTS``) is a set of nested field paths
with a declarative mapping that turns the record into canonical turns
``array<struct<role, text>>``. Layouts are told by schema fingerprints: the hash of a record's sorted
nested field paths is looked up in a table of fingerprints. The table starts with the layouts' own; a
schema that it does not hold (a layout's paths among others, say) is mapped once: to the layout with
the most paths whose fingerprint is that of the same paths found inside the schema, in the order of
``LAYOUTS`` where several have as many. Other fields are ignored. A typed DataFrame has one
fingerprint (``frame_layout``); JSON records have one each (``record_layouts``, one entry per different
schema; ``record_turns`` as plain expressions), so files may mix layouts.

Turns are rendered with a template whose control strings are escaped inside roles and texts
by a reversible rule, so no text can open or close a turn. The loss mask is a list of
(start, length) spans of the formatted text: the assistant texts.

Defined results: a null text or role is empty; a record of unknown layout keeps its row
with layout null and no turns; fields that its layout does not know are ignored, also
when their names clash with output columns; rows without a conversation id are conversations of one
turn each (nothing says which belong together); turns with equal numbers are ordered by
role, then text, and a null turn number comes last; repeated rows are repeated turns; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.llm.common import join_measured, saved

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
TURNS = "array<struct<role:string,text:string>>"
#: Order key of rows by turn: null turn numbers last, then role and text.
_ROW_KEY = ["conv_id", "turn", "role", "text"]


def _messages(root: str, role: str, text: str):
    """Mapping of a list of messages; other spellings of the roles become the canonical ones."""
    names = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}

    def turns(get):
        items = get(root, f"array<struct<{role}:string,{text}:string>>")
        spelled = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
        return F.transform(items, lambda m: F.struct(
            F.coalesce(F.get(F.array(spelled[m[role]]), F.lit(0)), m[role], F.lit("")).alias("role"),
            F.coalesce(m[text], F.lit("")).alias("text")))
    return turns


def _pairs(*fields: tuple[str, tuple[str, ...]]):
    """Mapping of flat fields: (role, fields joined by an empty line) in order."""
    def turns(get):
        made = []
        for role, names in fields:
            texts = [F.nullif(get(n, "string"), F.lit("")) for n in names]
            made.append(F.struct(F.lit(role).alias("role"), F.concat_ws("\n\n", *texts).alias("text")))
        return F.array(*made)
    return turns


#: Layout name -> (its field paths, its mapping).
LAYOUTS = {
    "messages": (("messages[].content", "messages[].role"), _messages("messages", "role", "content")),
    "conversations": (("conversations[].from", "conversations[].value"), _messages("conversations", "from", "value")),
    "prompt_response": (("prompt", "response"), _pairs(("user", ("prompt",)), ("assistant", ("response",)))),
    "prompt_completion": (("completion", "prompt"), _pairs(("user", ("prompt",)), ("assistant", ("completion",)))),
    "instruction": (("instruction", "output"), _pairs(("user", ("instruction",)), ("assistant", ("output",)))),
    "instruction_input": (("input", "instruction", "output"),
                          _pairs(("user", ("instruction", "input")), ("assistant", ("output",)))),
    "turn_rows": (("conv_id", "role", "text", "turn"), None),
}
#: Layout names, those with the most paths first.
BY_PATHS = sorted(LAYOUTS, key=lambda name: -len(LAYOUTS[name][0]))
#: Parts of a schema's text: quoted names, types with arguments, names, marks.
_TOKEN = r"`(?:[^`]|``)*`|\w+\([^)]*\)|[^\s<>:,`]+|[<>:,]"


def _plain(name: str) -> str:
    return name.replace(".", "\\.").replace("[", "\\[")


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Nested field paths of a schema; ``[]`` marks a list (dots and brackets of names are escaped)."""
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{_plain(f.name)}" if at else _plain(f.name))]
    return [at]


def fingerprint(paths: Column) -> Column:
    """The hash of nested field paths, whatever their order."""
    return F.xxhash64(F.array_join(F.array_sort(F.array_distinct(paths)), "\n"))


def layout_of(paths: Column, names: list[str] | None = None) -> Column:
    """The layout whose own fingerprint the paths have, or else the first of ``names`` (all) whose
    fingerprint its paths found among them have."""
    def own(name: str) -> Column:
        return F.array(*[F.lit(p) for p in LAYOUTS[name][0]])

    def chosen(held: Column) -> Column:
        whole, inside = F.lit(None).cast("string"), F.lit(None).cast("string")
        for name in reversed(BY_PATHS if names is None else names):
            known = fingerprint(own(name))
            whole = F.when(fingerprint(held) == known, F.lit(name)).otherwise(whole)
            inside = F.when(fingerprint(F.array_intersect(own(name), held)) == known, F.lit(name)).otherwise(inside)
        return F.coalesce(whole, inside)
    return _let(paths, chosen)


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def frame_layout(df: DataFrame) -> str | None:
    """The layout of a typed DataFrame, by the fingerprint of its schema."""
    paths = F.array(*[F.lit(p) for p in field_paths(df.schema)])
    return df.sparkSession.range(1).select(layout_of(paths).alias("layout")).first()["layout"]


def schema_paths(schema: Column) -> Column:
    """Nested field paths of a variant's schema, given as text (``OBJECT<a: ARRAY<OBJECT<b: STRING>>>``),
    read token by token: the open fields and lists stand on a stack, and a type's name ends a path."""
    def state(at: Column, paths: Column, last: Column) -> Column:
        return F.struct(at.alias("at"), paths.alias("paths"), last.alias("last"))

    def step(s: Column, t: Column) -> Column:
        top = F.element_at(s["at"], -1)
        below = F.slice(s["at"], 1, F.size(s["at"]) - 1)
        quoted = F.replace(F.substring(t, F.lit(2), F.length(t) - 2), F.lit("``"), F.lit("`"))
        name = F.when(t.startswith("`"), F.replace(F.replace(quoted, F.lit("."), F.lit("\\.")), F.lit("["), F.lit("\\["))).otherwise(t)
        field = F.when(top == "", s["last"]).otherwise(F.concat(top, F.lit("."), s["last"]))
        # "{" says that an object has been opened and holds nothing yet
        paths = F.when(s["last"].isin("", "{"), s["paths"]).otherwise(F.concat(s["paths"], F.array(top)))
        return F.when(t == ":", state(F.concat(s["at"], F.array(field)), s["paths"], F.lit(""))) \
            .when((t == "<") & (s["last"] == "OBJECT"), state(s["at"], s["paths"], F.lit("{"))) \
            .when(t == "<", state(F.concat(s["at"], F.array(F.concat(top, F.lit("[]")))), s["paths"], F.lit(""))) \
            .when((t == ">") & (s["last"] == "{"), state(s["at"], s["paths"], F.lit(""))) \
            .when(t.isin(",", ">"), state(below, paths, F.lit(""))) \
            .otherwise(state(s["at"], s["paths"], name))

    start = state(F.array(F.lit("")), F.array().cast("array<string>"), F.lit(""))
    return F.aggregate(F.regexp_extract_all(schema, F.lit(_TOKEN), F.lit(0)), start, step)["paths"]


def _mapped(variant: Column, layout: Column) -> Column:
    """The canonical turns of a record by the mapping of its layout."""
    get = lambda name, kind: F.try_variant_get(variant, f"$.{name}", kind)
    turns = F.lit(None).cast(TURNS)
    for name, (_, mapping) in LAYOUTS.items():
        if mapping:
            turns = F.when(layout == name, mapping(get)).otherwise(turns)
    return F.coalesce(turns, F.array().cast(TURNS))


#: Layouts of single records.
_RECORDS = [name for name in BY_PATHS if LAYOUTS[name][1]]


def record_turns(json: Column) -> tuple[Column, Column]:
    """(layout, canonical turns) of a JSON record per row, by the fingerprint of its own field paths."""
    variant = F.try_parse_json(json)
    layout = layout_of(schema_paths(F.schema_of_variant(variant)), _RECORDS)
    return layout, _mapped(variant, layout)


def record_layouts(df: DataFrame, json: str) -> DataFrame:
    """``df`` with ``layout`` and ``turns`` of the JSON records in the column ``json``: each different
    schema is fingerprinted and mapped once, and the rows look theirs up (broadcast within the
    measured limit, else by a shuffled join whose hot schemas adaptive execution splits)."""
    schema = F.schema_of_variant(F.try_parse_json(F.col(f"`{json}`")))
    shapes = df.select(schema.alias("_schema")).where("_schema is not null").distinct()
    table = saved(shapes.select(F.col("_schema").alias("schema"), layout_of(schema_paths(F.col("_schema")), _RECORDS).alias("layout")), "chat-fingerprints")
    told = join_measured(df, table, {"schema": schema})
    return told.withColumn("turns", _mapped(F.try_parse_json(F.col(f"`{json}`")), F.col("layout")))


def canonical(df: DataFrame, key: str = "conv_id") -> DataFrame:
    """(conv_id, layout, turns) of a typed DataFrame, its mapping chosen by its schema. Rows by turn are gathered per conversation; other layouts are row by row."""
    layout = frame_layout(df)
    if layout == "turn_rows":
        order = F.struct(F.col("turn").isNull().alias("late"), F.col("turn").alias("turn"),
                         F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
        rows = df.select(F.col(key).alias("conv_id"), order.alias("o"))
        many = rows.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("o")).alias("o"))
        lone = rows.where("conv_id is null").select("conv_id", F.array("o").alias("o"))
        return many.unionByName(lone).select("conv_id", F.lit(layout).alias("layout"), F.transform(
            "o", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))
    turns = F.array().cast(TURNS) if layout is None else LAYOUTS[layout][1](
        lambda name, kind: F.col(f"`{name}`").cast(kind) if not kind.startswith("array") else F.col(f"`{name}`"))
    return df.select((F.col(key) if key in df.columns else F.lit(None).cast("long")).alias("conv_id"),
                     F.lit(layout).cast("string").alias("layout"), F.coalesce(turns, F.array().cast(TURNS)).alias("turns"))


def escape(text: Column) -> Column:
    r"""``\`` becomes ``\\`` and ``<|`` becomes ``<\|``: no control string is left."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    """Inverse of ``escape``: pairs of backslashes are taken first, left to right."""
    parts = F.split(text, r"\\\\")
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\|"), F.lit("|"))), "\\")


def escape_role(role: Column) -> Column:
    r"""As ``escape``; a line break becomes ``\n``, as the first line break ends the role."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    parts = F.split(role, r"\\\\")
    one = lambda p: F.replace(F.replace(p, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|"))
    return F.array_join(F.transform(parts, one), "\\")


def format_turns(df: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Adds ``formatted`` (the rendered turns) and ``loss_mask`` (spans of its code points)
    to ``df`` (conv_id, layout, turns)."""
    parts = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"),
        (t["role"] == loss_role).alias("loss")))
    df = df.withColumn("_parts", parts)
    formatted = F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE + "\n"))), "")
    start = F.struct(F.lit(1).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))
    end = len(CLOSE) + 1

    def step(acc, p):
        begin = acc["at"] + F.length(p["head"])
        size = F.length(p["body"]).cast("long")
        one = F.array(F.struct(begin.alias("start"), size.alias("length")))
        return F.struct((begin + size + end).alias("at"), F.when(p["loss"], F.concat(acc["spans"], one))
                        .otherwise(acc["spans"]).alias("spans"))
    mask = F.aggregate("_parts", start, step, lambda acc: acc["spans"])
    return df.withColumn("formatted", formatted).withColumn("loss_mask", mask).drop("_parts")


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text: the template read back and unescaped."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p, i: i > 0)

    def one(p):
        head = F.substring_index(p, "\n", 1)
        body = F.substring(p, F.length(head) + 2, F.length(p) - F.length(head) - 1 - len(CLOSE) - 1)
        return F.struct(unescape_role(head).alias("role"), unescape(body).alias("text"))
    return F.transform(pieces, one)


def read_loss(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(mask, lambda s: unescape(F.substring(
        formatted, s["start"].cast("int"), s["length"].cast("int")))), "")


def digests(formatted: DataFrame) -> DataFrame:
    """What a formatted conversation says, read back from its text and mask."""
    read = formatted.withColumn("_turns", read_turns(F.col("formatted")))
    read = read.withColumn("_loss", read_loss(F.col("formatted"), F.col("loss_mask")))
    lines = F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select("conv_id", F.size("_turns").cast("long").alias("n_turns"),
                       F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
                       F.length("_loss").cast("long").alias("loss_chars"), F.sha2("_loss", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))
