"""Chat formatting: records of many layouts into one marked text with a loss mask.

A record is a JSON object. Its nested field paths (names only, array items as `[]`) are hashed
into a fingerprint, and the fingerprint selects a declarative mapping that says where turns stand:
one array of messages with a role and a text field each, or single fields that are a turn each. Every
mapping yields canonical turns (role, text), which are written with marks:

    [INST]role\\ntext[/INST]     for a turn that is read
    <s>role\\ntext</s>           for a turn of the assistant, which bears loss

Marks inside roles and texts are escaped by a tilde (`[INST]` becomes `[~INST]`, a tilde becomes two), so
that the formatted text can be read back exactly. Only DataFrame functions are used.

Null text counts as empty, a null role as the empty role. Records that are no JSON object or whose
fingerprint has no mapping get no turns and the layout `unknown`. Rows with a null conversation id
form one conversation; rows of one turn number are ordered by role and text, repeated rows stay. An empty
table gives an empty one. Only the named columns are read, so extra ones cannot clash.

The variant parser takes no text of 20 million characters and no record of 128 MB. Records of more than
`WHOLE` bytes get their fingerprint from an outline, in which texts are empty and equal neighbours
among array items stand once, and their turns from a JSON reader without these limits (numbers that
stand where a text should then keep their spelling). What no reader takes is an error, never a lost record. A
conversation is one value, so it ends at the 2 GB of a value in Spark.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.llm.common import free_name

LOSS_ROLE = "assistant"
TURNS = "array<struct<role:string,text:string>>"
WHOLE = 16_000_000  # bytes of a record that the variant parser surely takes


# --- marks --------------------------------------------------------------


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("~"), F.lit("~~"))
    for mark in ("[INST]", "[/INST]", "<s>", "</s>"):
        text = F.replace(text, F.lit(mark), F.lit(f"{mark[0]}~{mark[1:]}"))
    return text


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)~(.)", "$1")


def escape_role(role: Column) -> Column:
    """Roles end at the line break, so one inside a role is escaped too."""
    return F.replace(escape(role), F.lit("\n"), F.lit("~n"))


def unescape_role(role: Column) -> Column:
    """A tilde pair is settled before `~n` is looked for, piece by piece."""
    parts = F.transform(F.split(role, "~~", -1),
                        lambda p: unescape(F.replace(p, F.lit("~n"), F.lit("\n"))))
    return F.array_join(parts, "~")


def segments(turns: Column) -> Column:
    """Marked pieces in order with their part of the loss mask: array of (text, loss)."""
    def marked(turn: Column) -> Column:
        role, text = F.coalesce(turn["role"], F.lit("")), F.coalesce(turn["text"], F.lit(""))
        head = F.concat(escape_role(role), F.lit("\n"))
        piece = lambda value, loss: F.struct(value.alias("text"), F.lit(loss).alias("loss"))
        return F.when(role == LOSS_ROLE, F.array(
            piece(F.concat(F.lit("<s>"), head), False), piece(escape(text), True),
            piece(F.lit("</s>"), False))).otherwise(F.array(
                piece(F.concat(F.lit("[INST]"), head, escape(text), F.lit("[/INST]")), False)))

    return F.flatten(F.transform(turns, marked))


def formatted(pieces: Column) -> Column:
    return F.array_join(pieces["text"], "")


def read_back(text: Column) -> Column:
    """The turns of a formatted text."""
    ended = F.split(text, r"\[/INST\]|</s>", -1)
    bodies = F.transform(F.slice(ended, 1, F.size(ended) - 1),
                         lambda b: F.regexp_replace(b, r"^(\[INST\]|<s>)", ""))
    return F.transform(bodies, lambda b: F.struct(
        unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
        unescape(F.substring(b, F.locate("\n", b) + 1, F.length(b))).alias("text")))


# --- layouts ------------------------------------------------------------


@dataclass(frozen=True)
class Mapping:
    """Where the turns of a layout stand.

    `messages` is the path of an array with `role` and `text` inside its items, and `roles` renames
    the layout's roles. `fields` are (path, role) pairs, each a turn, taken in order.
    """

    name: str
    messages: str | None = None
    role: str = "role"
    text: str = "content"
    roles: tuple[tuple[str, str], ...] = ()
    fields: tuple[tuple[str, str], ...] = ()

    def leaves(self) -> list[str]:
        if self.messages:
            return [f"{self.messages}.[].{self.role}", f"{self.messages}.[].{self.text}"]
        return [path for path, _ in self.fields]

    def paths(self) -> list[str]:
        """All field paths of a record in this layout."""
        parts = [leaf.split(".") for leaf in self.leaves()]
        return sorted({".".join(p[:k]) for p in parts for k in range(1, len(p) + 1)})

    def kind(self) -> str:
        """Type of the messages."""
        return f"array<struct<`{self.role}`:string,`{self.text}`:string>>"

    def schema(self) -> str:
        """The type of a record in this layout."""
        leaves = [(self.messages, self.kind())] if self.messages else [
            (path, "string") for path, _ in self.fields]
        tree: dict = {}
        for path, kind in leaves:
            *above, leaf = path.split(".")
            inner = tree
            for name in above:
                inner = inner.setdefault(name, {})
            inner[leaf] = kind

        def written(of: dict) -> str:
            return "struct<" + ",".join(f"`{k}`:{v if isinstance(v, str) else written(v)}"
                                        for k, v in of.items()) + ">"

        return written(tree)

    def turns(self, record: Column) -> Column:
        """The canonical turns of a JSON record in this layout."""
        value = F.try_parse_json(record)
        # Without the limits; the outline has shown that the record is sound, so a failure is one of size.
        read = F.from_json(record, self.schema(), {"mode": "FAILFAST", "maxStringLen": str(2**31 - 1)})

        def large(path: str) -> Column:
            found = read
            for name in path.split("."):
                found = found[name]
            return found

        return F.when(is_whole(record), self.turns_of(
            lambda path, kind: F.try_variant_get(value, f"$.{path}", kind))).otherwise(
                self.turns_of(lambda path, _: large(path)))

    def turns_of(self, field: Callable[[str, str], Column]) -> Column:
        if not self.messages:
            return F.array(*(F.struct(F.lit(role).alias("role"),
                                      field(path, "string").alias("text"))
                             for path, role in self.fields))
        items = field(self.messages, self.kind())

        def turn(item: Column) -> Column:
            role = item[self.role]
            for theirs, ours in reversed(self.roles):
                role = F.when(item[self.role] == theirs, F.lit(ours)).otherwise(role)
            return F.struct(role.alias("role"), item[self.text].alias("text"))

        return F.transform(items, turn)

    def record(self, turns: Column) -> Column:
        """Canonical turns written as a JSON record of this layout."""
        def nested(path: str, value: Column) -> tuple[str, Column]:
            first, _, rest = path.partition(".")
            if not rest:
                return first, value
            name, inner = nested(rest, value)
            return first, F.struct(inner.alias(name))

        if self.messages:
            def item(turn: Column) -> Column:
                role = turn["role"]
                for theirs, ours in self.roles:
                    role = F.when(turn["role"] == ours, F.lit(theirs)).otherwise(role)
                return F.struct(role.alias(self.role), turn["text"].alias(self.text))

            name, value = nested(self.messages, F.transform(turns, item))
            return F.to_json(F.struct(value.alias(name)))
        columns: dict[str, list] = {}
        for k, (path, _) in enumerate(self.fields):
            above, _, leaf = path.rpartition(".")
            columns.setdefault(above, []).append(F.get(turns, F.lit(k))["text"].alias(leaf))
        (above, leaves), = columns.items()
        if not above:
            return F.to_json(F.struct(*leaves))
        name, value = nested(above, F.struct(*leaves))
        return F.to_json(F.struct(value.alias(name)))


MAPPINGS = (
    Mapping("messages", messages="messages"),
    Mapping("share", messages="conversations", role="from", text="value",
            roles=(("human", "user"), ("gpt", "assistant"))),
    Mapping("chosen", messages="example.messages", role="author", text="body"),
    Mapping("prompt", fields=(("prompt", "user"), ("completion", "assistant"))),
    Mapping("instruction", fields=(("instruction", "system"), ("input", "user"),
                                   ("output", "assistant"))),
    Mapping("question", fields=(("data.question", "user"), ("data.answer", "assistant"))),
)


# A JSON string. Possessive, so that long ones need no stack.
STRING = r'"(?:[^"\\\x00-\x1f]++|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+"'


def is_whole(record: Column) -> Column:
    return F.coalesce(F.octet_length(record), F.lit(0)) <= WHOLE


def outline(record: Column) -> Column:
    """The record with empty texts; of equal flat objects in a row the first stands alone."""
    body = STRING[1:-1]
    empty = F.regexp_replace(record, rf'({STRING}\s*+:)|("){body}(")', "$1$2$3")
    item = rf'\{{(?:[^{{}}"]++|{STRING})*+\}}'
    return F.regexp_replace(empty, rf"({STRING})|({item})(?:\s*+,\s*+\2)++", "$1$2")


def parsed(record: Column) -> Column:
    """The record, or the outline of a large one, as a variant; null when it is no JSON."""
    short = outline(record)
    refused = F.raise_error(F.lit("a record's outline is too large to tell its layout"))
    return F.when(is_whole(record), F.try_parse_json(record)).otherwise(
        F.when(is_whole(short), F.try_parse_json(short)).otherwise(
            F.coalesce(F.try_parse_json(short), refused.cast("variant"))))


def path_hash(paths: Column) -> Column:
    return F.xxhash64(F.array_join(F.array_sort(F.array_distinct(paths)), "\n"))


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a JSON object; null for anything else.

    The paths come from the record's own schema. Type names and the depth marks are dropped, so a
    layout keeps its fingerprint whether a field is text or null.
    """
    schema = F.schema_of_variant(parsed(record))
    # OBJECT<a: ARRAY<OBJECT<b: STRING>>> is walked as a list of tokens with a stack of names.
    tokens = F.regexp_extract_all(
        schema, F.lit(r"(`(?:[^`]|``)*`: |[^\s<>,:`]+: |OBJECT<|ARRAY<|>)"), F.lit(1))
    names = "array<string>"
    start = F.struct(F.array().cast(names).alias("stack"), F.lit("").alias("name"),
                     F.array().cast(names).alias("paths"))

    def step(state: Column, token: Column) -> Column:
        stack, name, paths = state["stack"], state["name"], state["paths"]
        above = F.coalesce(F.try_element_at(stack, F.lit(-1)), F.lit(""))
        field = F.regexp_replace(token, "^`|`?: $", "")
        path = F.when(above == "", field).otherwise(F.concat(above, F.lit("."), field))
        items = F.concat(name, F.lit(".[]"))

        def state_of(stack: Column, name: Column, paths: Column) -> Column:
            return F.struct(stack.alias("stack"), name.alias("name"), paths.alias("paths"))

        return (F.when(token == "OBJECT<", state_of(F.concat(stack, F.array(name)), name, paths))
                .when(token == "ARRAY<", state_of(F.concat(stack, F.array(items)), items,
                                                  F.concat(paths, F.array(items))))
                .when(token == ">", state_of(
                    F.slice(stack, 1, F.greatest(F.size(stack) - 1, F.lit(0))), name, paths))
                .otherwise(state_of(stack, path, F.concat(paths, F.array(path)))))

    walked = F.aggregate(tokens, start, step, lambda state: state["paths"])
    return F.when(F.startswith(schema, F.lit("OBJECT<")), path_hash(walked))


def canonical(records: DataFrame, record: str, mappings=MAPPINGS,
              layout: str = "layout", turns: str = "turns", strict: bool = False) -> DataFrame:
    """`records` with the layout's name and its canonical turns.

    With `strict`, for records that are known to be in one of the layouts, one that is not is an error.
    """
    print_name = free_name(records, "__fingerprint")
    marked = records.withColumn(print_name, fingerprint(F.col(record)))
    none = F.array().cast(TURNS)
    if strict:
        none = F.raise_error(F.lit("a record is in none of the layouts")).cast(TURNS)
    name, found = F.lit("unknown"), none
    for mapping in reversed(mappings):
        known = F.col(print_name) == path_hash(F.array(*map(F.lit, mapping.paths())))
        name = F.when(known, F.lit(mapping.name)).otherwise(name)
        found = F.when(known, F.coalesce(mapping.turns(F.col(record)).cast(TURNS),
                                         none)).otherwise(found)
    return marked.withColumn(layout, name).withColumn(turns, found).drop(print_name)


def chat_table(records: DataFrame, key: str, record: str, mappings=MAPPINGS,
               strict: bool = False) -> DataFrame:
    """Key, layout, formatted text and its pieces with the loss mask, for every record."""
    found = canonical(records.select(key, record), record, mappings, "__layout", "__turns", strict)
    pieces = found.select(key, F.col("__layout").alias("layout"),
                          segments(F.col("__turns")).alias("pieces"))
    return pieces.withColumn("formatted", formatted(F.col("pieces")))


# --- conversations ------------------------------------------------------


def gathered(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """One JSON record per conversation, in a layout that suits its turns.

    Pairs become prompt or question records, system-user-assistant triples instruction records, all
    others one of the message layouts.
    """
    entry = F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"),
                     F.coalesce(text, F.lit("")).alias("text"))
    turns = F.transform(F.array_sort(F.collect_list(entry)), lambda t: F.struct(
        t["role"].alias("role"), t["text"].alias("text")))
    convs = rows.groupBy(F.col(key).alias("key")).agg(turns.alias("turns"))
    by_name = {m.name: m.record(F.col("turns")) for m in MAPPINGS}
    said = F.array_join(F.col("turns")["role"], "\n")
    third = F.pmod(F.coalesce(F.xxhash64("key"), F.lit(0)), F.lit(3))
    renamed = F.arrays_overlap(F.col("turns")["role"], F.array(F.lit("human"), F.lit("gpt")))
    record = (F.when((said == "user\nassistant") & (F.size("turns") == 2),
                     F.when(third == 0, by_name["prompt"])
                     .when(third == 1, by_name["question"]).otherwise(by_name["messages"]))
              .when((said == "system\nuser\nassistant") & (F.size("turns") == 3),
                    by_name["instruction"])
              .when((third == 1) & ~renamed, by_name["share"])
              .when(third == 2, by_name["chosen"]).otherwise(by_name["messages"]))
    return convs.select(F.col("key").alias(key), record.alias("record"))


def digests(chats: DataFrame, key: str) -> DataFrame:
    """Figures of formatted chats, read back from the text and its mask."""
    read = chats.select(
        key, F.char_length("formatted").cast("bigint").alias("formatted_chars"),
        read_back(F.col("formatted")).alias("turns"),
        F.array_join(F.transform(F.filter("pieces", lambda p: p["loss"]),
                                 lambda p: unescape(p["text"])), "").alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        key, F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
