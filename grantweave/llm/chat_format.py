"""Chat records of many layouts as canonical turns, and turns as text with a loss mask.

A table of declarative mappings tells, for each known layout, which nested field paths it needs and where role and
text are. Of a parsed record the paths that any mapping names are listed, those of list items with ``[]``; what
else a record holds is left aside. The hash of this list is the record's fingerprint. A mapping is selected if the paths it
needs hash to the same value as those of them that the record has; of several, the one that needs most. A record
that no mapping fits keeps a null layout and null turns; it is not dropped, and ``layout_counts`` tells how many there
are of each fingerprint.

In the formatted text a turn is ``<turn role>text</turn>``. Backslashes and angle brackets inside roles and
texts are escaped as ``\\b``, ``\\l`` and ``\\g``, so a marker in a text is never taken for one and everything can be
read back. All steps are built-in expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: layouts by name: the paths a mapping needs, and the mapping. ``each`` names an array whose items have the fields for
#: role and text; ``fields`` lists role and path of each turn, empty texts left out.
LAYOUTS: dict[str, dict] = {
    "turn": {"paths": ["role", "text"], "fields": [("$.role", "$.text")], "roles_are_paths": True},
    "messages": {
        "paths": ["messages[]", "messages[].content", "messages[].role"],
        "each": ("$.messages", "role", "content"),
    },
    "conversations": {
        "paths": ["conversations[]", "conversations[].from", "conversations[].value"],
        "each": ("$.conversations", "from", "value"),
    },
    "instruction": {
        "paths": ["input", "instruction", "output"],
        "fields": [("user", "$.instruction", "$.input"), ("assistant", "$.output")],
    },
    "instruction_only": {
        "paths": ["instruction", "output"],
        "fields": [("user", "$.instruction"), ("assistant", "$.output")],
    },
    "system_prompt": {
        "paths": ["prompt", "response", "system"],
        "fields": [("system", "$.system"), ("user", "$.prompt"), ("assistant", "$.response")],
    },
    "prompt": {"paths": ["prompt", "response"], "fields": [("user", "$.prompt"), ("assistant", "$.response")]},
    "completion": {"paths": ["completion", "prompt"], "fields": [("user", "$.prompt"), ("assistant", "$.completion")]},
    "question": {"paths": ["answer", "question"], "fields": [("user", "$.question"), ("assistant", "$.answer")]},
}
#: other names of roles in list layouts
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}
LOSS_ROLE = "assistant"

TURNS = "array<struct<role: string, text: string>>"
_ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))


def _has(record: Column, path: str) -> Column:
    """Whether a parsed record has a path; of list items at least one must, unless there are none."""
    above, listed, field = path.partition("[]")
    if not listed:
        return F.try_variant_get(record, f"$.{path}", "variant").isNotNull()
    items = F.try_variant_get(record, f"$.{above}", "array<variant>")
    if not field:
        return items.isNotNull()
    some = F.exists(items, lambda item: F.try_variant_get(item, f"${field}", "variant").isNotNull())
    return some | (F.size(items) == 0)


def paths_of(record: Column) -> Column:
    """The nested field paths of a parsed record that some mapping names, sorted."""
    every = sorted({p for layout in LAYOUTS.values() for p in layout["paths"]})
    return F.array_compact(F.array(*[F.when(_has(record, p), F.lit(p)) for p in every]))


def _fingerprint(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "|"))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _mapped(record: Column, layout: dict) -> Column:
    def get(path: str) -> Column:
        return F.variant_get(record, path, "string")

    if "each" in layout:
        path, role, text = layout["each"]
        items = F.variant_get(record, path, "array<variant>")
        names = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])

        def turn(item: Column) -> Column:
            name = F.try_variant_get(item, f"$.{role}", "string")
            # A text may be given in parts; parts without text, such as images, have none.
            parts = F.try_variant_get(item, f"$.{text}", "array<struct<text: string>>")
            whole = F.array_join(F.transform(parts, lambda p: p["text"]), "\n")
            return _turn(F.coalesce(names[name], name), F.coalesce(whole, F.try_variant_get(item, f"$.{text}", "string")))

        return F.transform(items, turn)
    if layout.get("roles_are_paths"):
        return F.array(*[_turn(get(r), get(t)) for r, t in layout["fields"]])
    turns = []
    for role, first, *more in layout["fields"]:
        text = F.concat_ws("\n", *[F.nullif(get(p), F.lit("")) for p in (first, *more)])
        turns.append(_turn(F.lit(role), text))
    # Instructions without input, and prompts without a system text, have no such turn or line.
    return F.filter(F.array(*turns), lambda t: (t["text"] != "") | (t["role"] != "system"))


def canonical(records: DataFrame, json_column: str) -> DataFrame:
    """``records`` with ``layout`` (null if unknown), ``fingerprint`` and ``turns`` in place of the JSON column.

    Null and malformed JSON have null values in all three. Repeated rows and other columns stay as they are.
    """
    others = [F.col(f"`{c}`") for c in records.columns if c not in (json_column, "layout", "fingerprint", "turns")]
    parsed = records.select(*others, F.explode(F.array(F.try_parse_json(F.col(f"`{json_column}`")))).alias("_record"))
    parsed = parsed.select("*", F.explode(F.array(paths_of(F.col("_record")))).alias("_paths"))

    def fits(layout: dict) -> Column:
        needed = F.array(*map(F.lit, layout["paths"]))
        return _fingerprint(F.filter("_paths", lambda p: p.isin(*layout["paths"]))) == _fingerprint(needed)

    most_first = sorted(LAYOUTS, key=lambda n: -len(LAYOUTS[n]["paths"]))
    name = F.coalesce(*[F.when(fits(LAYOUTS[n]), F.lit(n)) for n in most_first])
    parsed = parsed.select("*", F.explode_outer(F.array(name)).alias("_layout"))
    turns = F.coalesce(*[F.when(F.col("_layout") == n, _mapped(F.col("_record"), m)) for n, m in LAYOUTS.items()])
    present = F.col("_record").isNotNull()
    return parsed.select(
        *others,
        F.when(present, F.col("_layout")).alias("layout"),
        F.when(present, _fingerprint(F.col("_paths"))).alias("fingerprint"),
        F.when(present, turns).cast(TURNS).alias("turns"),
    )


def layout_counts(mapped: DataFrame) -> DataFrame:
    """How many records of ``canonical`` have each ``layout`` and ``fingerprint``; null layouts are unknown ones."""
    return mapped.groupBy("layout", "fingerprint").agg(F.count(F.lit(1)).alias("records"))


def escaped(text: Column) -> Column:
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), _ESCAPES, text)


def unescaped(text: Column) -> Column:
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[1]), F.lit(pair[0])), reversed(_ESCAPES), text)


def formatted(turns: DataFrame, key: str, order: str, role: str = "role", text: str = "text") -> DataFrame:
    """A row per ``key`` from rows of single turns: ``formatted`` text and ``loss_mask``.

    The mask lists the spans of assistant texts in the UTF-8 bytes of the formatted text, as ``start`` and
    ``length``. Turns are ordered by ``order``, ties by role and text. Null roles and texts count as empty,
    rows with a null key are one conversation, and an empty table gives no rows. A conversation is one
    row of the result, so its turns meet in one task; nothing else has to.
    """
    rows = turns.select(
        F.col(f"`{key}`").alias(key),
        F.col(f"`{order}`").alias("_order"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("_role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"),
    ).select(
        key,
        "_order",
        "_role",
        "_text",
        F.concat(F.lit("<turn "), escaped(F.col("_role")), F.lit(">")).alias("_head"),
        escaped(F.col("_text")).alias("_body"),
    )
    rows = rows.withColumn("_piece", F.concat("_head", "_body", F.lit("</turn>")))
    window = W.partitionBy(key).orderBy("_order", "_role", "_text")
    rows = rows.select(
        key,
        F.row_number().over(window).alias("_n"),
        (F.sum(F.octet_length("_piece")).over(window.rowsBetween(W.unboundedPreceding, 0)) - F.octet_length("_piece")).alias("_begin"),
        "_role",
        F.octet_length("_head").alias("_head"),
        F.octet_length("_body").alias("_body"),
        "_piece",
    )
    span = F.struct((F.col("_begin") + F.col("_head")).alias("start"), F.col("_body").cast("long").alias("length"))
    grouped = rows.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("_n", "_piece"))).alias("_pieces"),
        F.sort_array(F.collect_list(F.when(F.col("_role") == LOSS_ROLE, span))).alias("loss_mask"),
    )
    return grouped.select(key, F.array_join(F.col("_pieces._piece"), "").alias("formatted"), "loss_mask")


def read_back(chats: DataFrame) -> DataFrame:
    """``chats`` with ``turns``, parsed from ``formatted``, and ``loss_text``, what the mask covers, both unescaped."""
    pieces = F.split("formatted", "</turn>")
    parts = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.split(p, ">", 2))
    turns = F.transform(
        parts,
        lambda p: F.struct(
            unescaped(F.substr(p[0], F.lit(len("<turn ") + 1))).alias("role"), unescaped(p[1]).alias("text")
        ),
    )
    # Bytes are made once per row; a span is then cut without a walk from the start of the text.
    raw = chats.select("*", F.explode(F.array(F.encode("formatted", "UTF-8"))).alias("_bytes"))
    spans = F.transform(
        "loss_mask", lambda s: F.decode(F.substr(F.col("_bytes"), (s["start"] + 1).cast("int"), s["length"].cast("int")), "UTF-8")
    )
    return raw.select(*chats.columns, turns.alias("turns"), F.transform(spans, unescaped).alias("loss_text")).drop("_bytes")
