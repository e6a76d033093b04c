"""Chat formatting with schema fingerprints.

Conversations arrive in many layouts (rows by turn, prompt and response, instruction and
input and output, arrays of messages).  The sorted paths of a layout's nested fields are
hashed; the hash selects a declarative mapping, a set of SQL expressions that yields the
canonical turns (role, text).  Tables are matched by their schema, JSON payloads row by row
by the paths found in the row.  Everything runs as built-in expressions.

The template is ``<|start|>role<|says|>text<|end|>`` per turn.  Inside roles and texts a
control string (one of ``CONTROL``) is broken by a backslash after its first character and a
backslash is doubled, so no text can forge a mark and the text is read back exactly.

Defined results: null roles and texts read as empty; turns order by (turn, role, text), so
ties and repeated rows have one order and all stay; a null conversation id is one
conversation; texts of any length stay whole; an empty table gives no conversation; extra
columns that no mapping names are ignored, also where a fingerprint does not match as it
stands (the mapping with the most paths present is then taken).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, SAYS, END = "<|start|>", "<|says|>", "<|end|>"
#: The control strings of this template and of common chat templates.
CONTROL = (START, SAYS, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
           "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|system|>", "<|user|>",
           "<|assistant|>")
LOSS_ROLE = "assistant"

_TURNS = "array<struct<role: string, text: string>>"


def _pairs(*turns: tuple[str, str]) -> str:
    """SQL of an array of turns; a turn whose text is null is left out."""
    items = ", ".join(f"named_struct('role', {role}, 'text', CAST({text} AS STRING))"
                      for role, text in turns)
    return f"filter(array({items}), t -> t.text IS NOT NULL)"


def _each(column: str, role: str, text: str) -> str:
    return (f"transform({column}, m -> named_struct('role', m.{role}, "
            f"'text', CAST(m.{text} AS STRING)))")


_FROM = ("transform(conversations, m -> named_struct('role', CASE m.`from` WHEN 'human' THEN 'user' "
         "WHEN 'gpt' THEN 'assistant' ELSE m.`from` END, 'text', CAST(m.value AS STRING)))")

#: layout: (paths of its nested fields, SQL of its turns; None: the row is one turn)
LAYOUTS = {
    "turn_rows": (("role", "text", "turn"), None),
    "messages": (("messages", "messages.content", "messages.role"),
                 _each("messages", "role", "content")),
    "turns": (("turns", "turns.role", "turns.text"), _each("turns", "role", "text")),
    "from_value": (("conversations", "conversations.from", "conversations.value"), _FROM),
    "instruction_input": (("input", "instruction", "output"), _pairs(
        ("'user'", "concat_ws('\\n\\n', instruction, nullif(input, ''))"),
        ("'assistant'", "output"))),
    "instruction": (("instruction", "output"),
                    _pairs(("'user'", "instruction"), ("'assistant'", "output"))),
    "system_prompt": (("prompt", "response", "system"), _pairs(
        ("'system'", "system"), ("'user'", "prompt"), ("'assistant'", "response"))),
    "prompt_response": (("prompt", "response"),
                        _pairs(("'user'", "prompt"), ("'assistant'", "response"))),
    "prompt_completion": (("completion", "prompt"),
                          _pairs(("'user'", "prompt"), ("'assistant'", "completion"))),
    "question_answer": (("answer", "question"),
                        _pairs(("'user'", "question"), ("'assistant'", "answer"))),
}
_KNOWN = sorted({p for paths, _ in LAYOUTS.values() for p in paths})


def fingerprint(paths) -> str:
    """Hash of a set of nested field paths."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


FINGERPRINTS = {fingerprint(paths): name for name, (paths, _) in LAYOUTS.items()}


def schema_paths(schema: T.DataType, prefix: str = "") -> list[str]:
    """Dotted paths of all nested fields; arrays are looked through."""
    while isinstance(schema, T.ArrayType):
        schema = schema.elementType
    if not isinstance(schema, T.StructType):
        return []
    out = []
    for field in schema.fields:
        path = f"{prefix}{field.name}"
        out += [path, *schema_paths(field.dataType, f"{path}.")]
    return out


def select_layout(schema: T.StructType) -> str:
    """The layout of a table, by the fingerprint of its known paths."""
    known = [p for p in schema_paths(schema) if p in _KNOWN]
    exact = FINGERPRINTS.get(fingerprint(known))
    if exact:
        return exact
    fitting = [n for n, (paths, _) in LAYOUTS.items() if set(paths) <= set(known)]
    if not fitting:
        raise ValueError(f"no layout fits the fields {sorted(schema_paths(schema))}")
    return max(fitting, key=lambda n: len(LAYOUTS[n][0]))


def canonical_turns(df: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Any known layout -> ``conv_id, turns`` (one row per conversation)."""
    name = select_layout(df.schema)
    if name == "turn_rows":
        # one conversation is one output string, so its rows do meet in one place
        turn = F.struct(F.col("turn").cast("long").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        rows = df.groupBy(F.col(id_col).alias("conv_id")).agg(
            F.array_sort(F.collect_list(turn)).alias("rows"))
        turns = F.transform("rows", lambda t: F.struct(t["role"].alias("role"),
                                                       t["text"].alias("text")))
        return rows.select("conv_id", turns.cast(_TURNS).alias("turns"))
    return df.select(F.col(id_col).alias("conv_id"),
                     _filled(F.expr(LAYOUTS[name][1])).alias("turns"))


def _filled(turns: Column) -> Column:
    clean = F.transform(turns, lambda t: F.struct(
        F.coalesce(t["role"].cast("string"), F.lit("")).alias("role"),
        F.coalesce(t["text"].cast("string"), F.lit("")).alias("text")))
    return F.coalesce(clean, F.array().cast(_TURNS)).cast(_TURNS)


def json_fingerprint(payload: Column) -> Column:
    """Fingerprint of the known paths in a JSON text, row by row (null: not JSON)."""
    top = F.coalesce(F.json_object_keys(payload), F.array().cast("array<string>"))

    def inside(field: str) -> Column:
        keys = F.json_object_keys(F.get_json_object(payload, f"$.{field}[0]"))
        return F.transform(F.coalesce(keys, F.array().cast("array<string>")),
                           lambda k: F.concat(F.lit(f"{field}."), k))
    nested = [inside(f) for f in sorted({p.split(".")[0] for p in _KNOWN if "." in p})]
    known = F.array(*(F.lit(p) for p in _KNOWN))
    paths = F.array_sort(F.array_intersect(F.concat(top, *nested), known))
    return F.when(F.json_object_keys(payload).isNotNull(),
                  F.substring(F.sha2(F.array_join(paths, "\n"), 256), 1, 16))


def json_turns(df: DataFrame, payload_col: str = "payload", id_col: str = "conv_id") -> DataFrame:
    """JSON payloads of mixed layouts -> ``conv_id, layout, turns``.  A payload that matches
    no layout has a null layout and no turns."""
    fields = {"messages": "array<struct<role: string, content: string>>",
              "turns": _TURNS,
              "conversations": "array<struct<`from`: string, value: string>>"}
    payload = F.col(payload_col)
    names = sorted({p.split(".")[0] for p in _KNOWN} - {"turn", "role", "text"})
    schema = ", ".join(f"`{n}` {fields.get(n, 'string')}" for n in names)
    parsed = df.select(F.col(id_col).alias("conv_id"), json_fingerprint(payload).alias("_print"),
                       F.from_json(payload, schema).alias("_p"))
    parsed = parsed.select("conv_id", "_print", "_p.*")
    layout, turns = F.lit(None).cast("string"), F.array().cast(_TURNS)
    for key, name in FINGERPRINTS.items():
        if LAYOUTS[name][1]:
            hit = F.col("_print") == key
            layout = F.when(hit, name).otherwise(layout)
            turns = F.when(hit, _filled(F.expr(LAYOUTS[name][1]))).otherwise(turns)
    return parsed.select("conv_id", layout.alias("layout"), turns.alias("turns"))


def _quoted(s: str) -> str:
    return "".join("\\" + c if not c.isalnum() else c for c in s)


_BREAK = r"(\\)|([<\[])(?=" + "|".join(
    dict.fromkeys(_quoted(c[1:]) for c in CONTROL)) + ")"


def escape(text: Column) -> Column:
    """Break control strings and double backslashes."""
    return F.regexp_replace(text, F.lit(_BREAK), F.lit(r"$1$2\\"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"\\(\\?)"), F.lit("$1"))


def format_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turns`` -> ``conv_id, formatted, loss_mask``.

    ``loss_mask`` has one (before, loss, after) triple per turn: code points outside, under
    and outside the loss mask; laid end to end they cover ``formatted``.
    """
    coded = turns.withColumn("_coded", F.transform("turns", lambda t: F.struct(
        escape(t["role"]).alias("role"), escape(t["text"]).alias("text"),
        (t["role"] == LOSS_ROLE).alias("loss"))))
    turn = lambda t: F.concat(F.lit(START), t["role"], F.lit(SAYS), t["text"], F.lit(END))
    head = lambda t: F.length(t["role"]) + len(START) + len(SAYS)
    mask = F.transform("_coded", lambda t: F.struct(
        F.when(t["loss"], head(t)).otherwise(head(t) + F.length(t["text"])).alias("before"),
        F.when(t["loss"], F.length(t["text"])).otherwise(0).alias("loss"),
        F.lit(len(END)).alias("after")))
    return coded.select("conv_id", F.array_join(F.transform("_coded", turn), "").alias("formatted"),
                        mask.alias("loss_mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted, loss_mask`` -> ``conv_id, formatted, turns, loss_text``, from the output
    alone: split at the marks, unescape, and take what lies under the mask."""
    segments = F.split(F.col("formatted"), _quoted(START))
    turns = formatted.withColumn("_segments", F.slice(segments, 2, F.greatest(
        F.size(segments) - 1, F.lit(0))))
    parts = F.transform("_segments", lambda s: F.struct(
        F.substring_index(s, SAYS, 1).alias("role"),
        F.substring_index(F.substring_index(s, SAYS, -1), END, 1).alias("text")))
    # a segment lacks its start mark, so the mask's place in it is that much earlier
    under = F.zip_with("_segments", "loss_mask", lambda s, m: unescape(
        s.substr(m["before"] - len(START) + 1, m["loss"])))
    return turns.select(
        "conv_id", "formatted",
        F.transform(parts, lambda t: F.struct(unescape(t["role"]).alias("role"),
                                              unescape(t["text"]).alias("text"))).alias("turns"),
        F.array_join(under, "").alias("loss_text"))


def digests(read: DataFrame) -> DataFrame:
    """The digest columns of conversations that were read back."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
