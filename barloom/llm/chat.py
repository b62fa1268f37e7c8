"""Operator 2: chat formatting by schema fingerprints; DataFrame functions only.

Records of several layouts (message lists, instruction and output, prompt and response) are told
apart by the nested field paths that are filled in them: the sorted paths are hashed, and the hash
selects a declarative mapping, which turns the record into canonical turns ``(role, text)``. A new
layout is a new ``Layout`` line.

The template marks turns with control strings. The same strings inside roles and texts are broken
by a backslash, which reading back takes out again, so any text survives and none can end a turn.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from barloom.llm.texts import free_names, table

BEGIN, END = "<|im_start|>", "<|im_end|>"
#: Control strings of common templates; none of them stays whole inside a text.
CONTROL = r"(<|\[)(\\*)(\||/?s>|/?INST\]|<SYS>>|</SYS>>)"
ESCAPED = r"(<|\[)(\\*)\\(\||/?s>|/?INST\]|<SYS>>|</SYS>>)"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """How one layout becomes turns.

    ``single``: (role, path) of text fields, in order. ``items``: the path of a list of messages,
    with the names of its role and text fields. ``optional`` paths may be missing. ``renames``: the
    layout has names of its own for roles (``ROLES``); otherwise roles stay as they are written.
    """

    name: str
    single: tuple[tuple[str, str], ...] = ()
    items: tuple[str, str, str] | None = None
    optional: frozenset[str] = field(default_factory=frozenset)
    renames: bool = False

    def paths(self) -> list[str]:
        found = [path for _, path in self.single]
        if self.items:
            where, role, text = self.items
            found += [f"{where}[].{role}", f"{where}[].{text}"]
        return found


LAYOUTS = (
    Layout("messages", items=("messages", "role", "content"), single=(("system", "system"),), optional=frozenset({"system"})),
    Layout("conversations", items=("conversations", "from", "value"), single=(("system", "system"),), optional=frozenset({"system"}), renames=True),
    Layout("turns", items=("turns", "role", "text")),
    Layout("instruction", single=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=frozenset({"system", "input"})),
    Layout("prompt-response", single=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=frozenset({"system"})),
    Layout("prompt-completion", single=(("user", "prompt"), ("assistant", "completion"))),
    Layout("question-answer", single=(("user", "question"), ("assistant", "answer"))),
)

#: Names of the same role in layouts that have names of their own.
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def field_paths(kind: DataType, at: str = "") -> list[str]:
    """All nested paths of a schema; ``[]`` stands for the items of a list."""
    if isinstance(kind, StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    return [at]


def _filled(path: str) -> Column:
    """Whether a path has a value: for items of a list, whether one of them has."""
    where, _, inside = path.partition("[].")
    if not inside:
        return F.col(where).isNotNull()
    return F.coalesce(F.exists(where, lambda x: x[inside].isNotNull()), F.lit(False))


def fingerprint(schema: StructType, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Hash of the sorted nested paths filled in a record, among those that layouts speak of."""
    spoken = {p for layout in layouts for p in layout.paths()}
    paths = sorted(spoken & set(field_paths(schema)))
    present = F.concat_ws("\n", *[F.when(_filled(p), F.lit(p)) for p in paths]) if paths else F.lit("")
    return F.xxhash64(present)


def _fingerprints(layout: Layout) -> list[Column]:
    """The hashes that a layout answers to: with any of its optional paths."""
    needed = [p for p in layout.paths() if p not in layout.optional]
    optional = sorted(layout.optional)
    chosen = [c for n in range(len(optional) + 1) for c in combinations(optional, n)]
    return [F.xxhash64(F.lit("\n".join(sorted([*needed, *c])))) for c in chosen]


def _role(name: Column) -> Column:
    value = F.coalesce(name.cast("string"), F.lit(""))
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair]), value), value)


def _turns(layout: Layout, known: set[str]) -> Column:
    """A layout's turns; an optional text that is missing gives none, a null message text is empty."""
    made = F.array(*[
        F.when(F.col(path).isNotNull(), F.struct(F.lit(role).alias("role"), F.col(path).cast("string").alias("text")))
        for role, path in layout.single if path in known
    ]).cast(TURNS)
    made = F.filter(made, lambda t: t.isNotNull())
    if not layout.items:
        return made
    where, role, text = layout.items
    return F.concat(made, F.transform(
        where, lambda m: F.struct((_role(m[role]) if layout.renames else F.coalesce(m[role].cast("string"), F.lit(""))).alias("role"), F.coalesce(m[text].cast("string"), F.lit("")).alias("text"))
    ))


def canonical_turns(records: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """All columns of ``records``, ``layout`` and ``turns``; columns of those names are replaced.

    ``layout`` is null and ``turns`` empty where no mapping answers to the record's fingerprint.
    Columns that no layout speaks of do not matter. The input must not use ``turns`` for something
    else than a list of role and text.
    """
    known = set(field_paths(records.schema))
    (mark,) = free_names(records.columns, "__mark")
    name, turns = F.lit(None).cast("string"), F.array().cast(TURNS)
    for layout in layouts:
        if all(p in known for p in layout.paths() if p not in layout.optional):
            mine = F.col(mark).isin(*[x for x in _fingerprints(layout)])
            name, turns = F.when(mine, layout.name).otherwise(name), F.when(mine, _turns(layout, known)).otherwise(turns)
    kept = [c for c in records.columns if c not in ("layout", "turns")]
    return records.withColumn(mark, fingerprint(records.schema, layouts)).select(
        *[F.col(f"`{c}`") for c in kept], name.alias("layout"), turns.cast(TURNS).alias("turns")
    )


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    whole = unescape(role)
    pieces = F.transform(F.split(whole, r"\\\\"), lambda p: F.replace(p, F.lit("\\n"), F.lit("\n")))
    return F.array_join(pieces, "\\")


def format_turns(rows: DataFrame, turns: str = "turns", trained: str = "assistant") -> DataFrame:
    """All columns of ``rows``, ``formatted`` and ``loss_spans``; columns of those names are replaced.

    ``loss_spans`` are the code points of ``formatted``, first included and last excluded, that
    hold the escaped texts of the ``trained`` role: the loss mask. No turns give an empty text.
    """
    rows = rows.drop(*({"formatted", "loss_spans"} - {turns}))
    marked = F.transform(F.coalesce(F.col(turns), F.array().cast(TURNS)), lambda t: F.struct(
        F.concat(F.lit(BEGIN), _escape_role(F.coalesce(t["role"], F.lit(""))), F.lit("\n")).alias("head"),
        escape(F.coalesce(t["text"], F.lit(""))).alias("body"), F.coalesce(t["role"] == trained, F.lit(False)).alias("mine"),
    ))
    tail = len(END) + 1
    kind = "array<struct<first:long,last:long>>"
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(kind).alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        first = (state["at"] + F.length(turn["head"])).cast("long")
        last = (first + F.length(turn["body"])).cast("long")
        one = F.array(F.struct(first.alias("first"), last.alias("last")))
        return F.struct(
            (last + tail).cast("long").alias("at"),
            F.when(turn["mine"], F.concat(state["spans"], one)).otherwise(state["spans"]).alias("spans"),
        )

    (parts,) = free_names(rows.columns, "__marked")
    whole = F.array_join(F.transform(parts, lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))), "")
    spans = F.aggregate(parts, start, step, lambda s: s["spans"])
    return rows.withColumn(parts, marked).withColumn("formatted", whole).withColumn("loss_spans", spans).drop(parts)


def read_turns(formatted: Column) -> Column:
    """The turns that a formatted text holds, as they were before."""
    pieces = F.split(formatted, r"<\|im_end\|>\n", -1)
    bodies = F.slice(pieces, 1, F.size(pieces) - 1)

    def one(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        return F.struct(
            _unescape_role(F.substr(head, F.lit(len(BEGIN) + 1))).alias("role"),
            unescape(F.substr(piece, F.length(head) + 2)).alias("text"),
        )

    return F.transform(bodies, one)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, (s["first"] + 1).cast("int"), (s["last"] - s["first"]).cast("int")))), "")


def gather_turns(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows by turn as records ``key`` and ``messages``, ordered by turn, then role and text.

    Null texts and roles are empty, a null turn comes first, repeated rows stay. A conversation
    becomes one record, so its texts meet in one row: that is the result asked for, and a
    conversation is as large as what a trainer reads at once. Texts are combined as they arrive.
    """
    one = F.struct(
        F.col(turn), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("content")
    )
    gathered = rows.groupBy(key).agg(F.sort_array(F.collect_list(one)).alias("__rows"))
    return gathered.select(key, F.transform("__rows", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content"))).alias("messages"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_turn = gather_turns(table(spark, sf_dir, "conversations"))
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(F.lit(-1).cast("long").alias("conv_id"), F.lit(said).alias("prompt"), F.lit(said).alias("response"))
    records = by_turn.unionByName(extra, allowMissingColumns=True)
    done = format_turns(canonical_turns(records).select("conv_id", "layout", "turns")).select("conv_id", "layout", "formatted", "loss_spans")
    read = done.withColumn("turns", read_turns(F.col("formatted"))).withColumn("loss", masked_text(F.col("formatted"), F.col("loss_spans")))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "layout",
    )


OP2_SQL = r"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
turns as (
  select *, regexp_replace(text, '(<|\[)(\\*)(\||/?s>|/?INST\]|<SYS>>|</SYS>>)', '\1\2\\\3', 'g') as escaped, role as name from said)
select conv_id, count(*) as n_turns,
       sha256(string_agg(name || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (name = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (name = 'assistant'), '')) as loss_sha256,
       sum(length(escaped) + length(name) + 24)::bigint as formatted_chars,
       case when conv_id = -1 then 'prompt-response' else 'messages' end as layout
from turns group by conv_id
"""
