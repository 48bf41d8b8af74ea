"""Conversations: ``messages ARRAY<STRUCT<role, content, parts>>`` and what is done with them.

Exactly one of ``content`` (string) and ``parts`` (array of ``type, text``) is set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "struct<type:string,text:string>"
MESSAGES = f"array<struct<role:string,content:string,parts:array<{PART}>>>"
# Special tokens and part types.
SPECIALS = ["<|bos|>", "<|user_start|>", "<|user_end|>", "<|assistant_start|>", "<|assistant_end|>", "<|python_start|>", "<|python_end|>", "<|output_start|>", "<|output_end|>"]
PART_TYPES = ["text", "python", "python_output"]


def assemble(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """``conv, messages`` from one row a turn, in turn order."""
    row = F.struct(turn, F.struct("role", F.col("text").alias("content"), F.lit(None).cast(f"array<{PART}>").alias("parts")).alias("m"))
    return turns.groupBy(conv).agg(F.transform(F.array_sort(F.collect_list(row)), lambda r: r["m"]).alias("messages"))


def message_text(m: Column) -> Column:
    """Content, or the parts' texts put together."""
    return F.coalesce(m["content"], F.array_join(F.transform(m["parts"], lambda p: p["text"]), ""))


def formatted(messages: Column) -> Column:
    """``### ROLE`` and the text of each message, a blank line between."""
    return F.array_join(F.transform(messages, lambda m: F.concat(F.lit("### "), F.upper(m["role"]), F.lit("\n"), message_text(m))), "\n\n")


def canonical(messages: Column) -> Column:
    """JSON with sorted keys and single spaces, the same for the same conversation."""
    quoted = lambda s: F.to_json(F.array(s)).substr(F.lit(2), F.length(F.to_json(F.array(s))) - 2)
    part = lambda p: F.concat(F.lit('{"text": '), quoted(p["text"]), F.lit(', "type": '), quoted(p["type"]), F.lit("}"))
    body = lambda m: F.coalesce(quoted(m["content"]), F.concat(F.lit("["), F.array_join(F.transform(m["parts"], part), ", "), F.lit("]")))
    return F.concat(F.lit("["), F.array_join(F.transform(messages, lambda m: F.concat(F.lit('{"content": '), body(m), F.lit(', "role": '), quoted(m["role"]), F.lit("}"))), ", "), F.lit("]"))


def content_hash(messages: Column) -> Column:
    return F.sha2(canonical(messages), 256)


def blank(text: Column) -> Column:
    return F.coalesce(F.trim(text) == "", F.lit(True))


def _alternates(m: Column) -> Column:
    roles = F.transform(m, lambda x, i: x["role"] == F.when(i % 2 == 0, "user").otherwise("assistant"))
    return F.forall(roles, lambda x: F.coalesce(x, F.lit(False)))


def without_system(messages: Column) -> Column:
    """Messages after a leading system message."""
    return F.when(F.get(messages, F.lit(0))["role"] == "system", F.slice(messages, 2, F.greatest(F.size(messages), F.lit(1)))).otherwise(messages)


def valid_pair(messages: Column) -> Column:
    """A user and an assistant message, both with words."""
    return (F.size(messages) == 2) & _alternates(messages) & F.forall(messages, lambda m: ~blank(m["content"]))


def valid_turns(messages: Column) -> Column:
    """Two or more messages with words, user and assistant in turn."""
    return (F.size(messages) >= 2) & _alternates(messages) & F.forall(messages, lambda m: ~blank(m["content"]))


def valid_chat(messages: Column) -> Column:
    """Roles in turn after an optional system message, at least two of them."""
    rest = without_system(messages)
    return (F.size(rest) >= 2) & _alternates(rest)


def valid_tool_use(messages: Column) -> Column:
    """A user message with words; parts of known types, text first, one python part at least."""
    user, parts = F.get(messages, F.lit(0)), F.get(messages, F.lit(1))["parts"]
    known = F.forall(parts, lambda p: p["type"].isin(PART_TYPES))
    fits = (F.size(messages) == 2) & _alternates(messages) & ~blank(user["content"]) & (F.size(parts) > 0) & known & (F.get(parts, F.lit(0))["type"] == "text") & F.exists(parts, lambda p: p["type"] == "python")
    return F.coalesce(fits, F.lit(False))


def merged_system(messages: Column) -> Column:
    """A leading system message joined to the first user message by a blank line."""
    first, second = F.get(messages, F.lit(0)), F.get(messages, F.lit(1))
    joined = F.struct(second["role"].alias("role"), F.concat(first["content"], F.lit("\n\n"), second["content"]).alias("content"), second["parts"].alias("parts"))
    return F.when((first["role"] == "system") & second["role"].isNotNull(), F.concat(F.array(joined), F.slice(messages, 3, F.greatest(F.size(messages), F.lit(1))))).otherwise(messages)


def _piece(text: Column, mask: int) -> Column:
    return F.struct(text.alias("text"), F.lit(mask).alias("mask"))


def _parts_pieces(p: Column) -> Column:
    tag = lambda x: F.lit(f"<|{x}|>")
    python = F.array(_piece(tag("python_start"), 1), _piece(p["text"], 1), _piece(tag("python_end"), 1))
    output = F.array(_piece(tag("output_start"), 0), _piece(p["text"], 0), _piece(tag("output_end"), 0))
    return F.when(p["type"] == "python", python).when(p["type"] == "python_output", output).otherwise(F.array(_piece(p["text"], 1)))


def segments(messages: Column) -> Column:
    """Rendered conversation as ``text, mask`` pieces: specials, texts, and what is trained on."""

    def one(m: Column) -> Column:
        tag = lambda x: F.lit(f"<|{x}|>")
        user = F.array(_piece(tag("user_start"), 0), _piece(m["content"], 0), _piece(tag("user_end"), 0))
        body = F.when(m["content"].isNotNull(), F.array(_piece(m["content"], 1))).otherwise(F.flatten(F.transform(m["parts"], _parts_pieces)))
        return F.when(m["role"] == "user", user).otherwise(F.concat(F.array(_piece(tag("assistant_start"), 0)), body, F.array(_piece(tag("assistant_end"), 1))))

    return F.concat(F.array(_piece(F.lit("<|bos|>"), 0)), F.flatten(F.transform(merged_system(messages), one)))


def completion_segments(messages: Column) -> Column:
    """Pieces up to where the last assistant message starts; to cut them to a length see :func:`completion_ids`."""
    dropped = F.when(F.get(messages, F.size(messages) - 1)["role"] == "assistant", F.slice(messages, 1, F.greatest(F.size(messages) - 1, F.lit(0)))).otherwise(messages)
    return F.array_append(segments(dropped), _piece(F.lit("<|assistant_start|>"), 0))


def completion_ids(messages: Column, longest: int | None = 2048) -> Column:
    """Byte-level ids and mask before an answer: cut to ``longest`` first, so that the start marker always comes last."""
    dropped = F.when(F.get(messages, F.size(messages) - 1)["role"] == "assistant", F.slice(messages, 1, F.greatest(F.size(messages) - 1, F.lit(0)))).otherwise(messages)
    marker = F.struct(F.lit(256 + SPECIALS.index("<|assistant_start|>")).alias("id"), F.lit(0).alias("mask"))
    return F.array_append(byte_ids(segments(dropped), longest), marker)


def byte_ids(pieces: Column, longest: int | None = 2048) -> Column:
    """Byte-level ids and mask of pieces: bytes are 0 to 255, specials follow.

    A whole piece that spells a special token is that token; render texts with
    :func:`segments` so that only markers do.
    """
    ranks = F.create_map(*[x for i, s in enumerate(SPECIALS) for x in (F.lit(s), F.lit(256 + i))])

    def expand(p: Column) -> Column:
        special = F.try_element_at(ranks, p["text"])
        hexed = F.hex(F.encode(p["text"], "utf-8"))
        plain = F.transform(F.filter(F.sequence(F.lit(0), F.octet_length(p["text"])), lambda i: i < F.octet_length(p["text"])), lambda i: F.conv(F.substring(hexed, i * 2 + 1, F.lit(2)), 16, 10).cast("int"))
        return F.transform(F.when(special.isNotNull(), F.array(special)).otherwise(plain), lambda b: F.struct(b.alias("id"), p["mask"].alias("mask")))

    both = F.flatten(F.transform(pieces, expand))
    return F.slice(both, 1, longest) if longest else both


def mask_view(pieces: Column) -> Column:
    """Pieces with their mask, for looking at."""
    return F.array_join(F.transform(pieces, lambda p: F.concat(p["text"], F.lit("("), p["mask"].cast("string"), F.lit(")"))), "|")


def calculator_parts(answer: Column) -> Column:
    """Text with ``<<expr=result>>`` as text, python and python_output parts; split at the last ``=``."""
    pieces = F.regexp_extract_all(answer, F.lit(r"(?s)(<<.*?>>|(?:(?!<<.*?>>).)+)"), F.lit(1))

    def typed(p: Column) -> Column:
        inner = F.substring(p, F.lit(3), F.length(p) - 4)
        has = F.contains(inner, F.lit("="))
        expr = F.when(has, F.regexp_extract(inner, r"(?s)^(.*)=", 1)).otherwise(inner)
        result = F.when(has, F.regexp_extract(inner, r"(?s)=([^=]*)$", 1)).otherwise(F.lit(""))
        part = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.alias("text"))
        return F.when(p.rlike(r"(?s)^<<.*>>$"), F.array(part("python", expr), part("python_output", result))).otherwise(F.array(part("text", p)))

    return F.flatten(F.transform(pieces, typed))


def request_error(messages: Column, most: int = 500, longest: int = 8000, total: int = 32000) -> Column:
    """Null for an acceptable chat request, else the code of the first rule it breaks."""
    sizes = F.transform(messages, lambda m: F.length(m["content"]))
    return (
        F.when(F.coalesce(F.size(messages), F.lit(0)) == 0, "empty")
        .when(F.size(messages) > most, "too_many_messages")
        .when(F.exists(messages, lambda m: F.coalesce(m["content"] == "", F.lit(True))), "empty_message")
        .when(F.exists(sizes, lambda n: n > longest), "message_too_long")
        .when(F.aggregate(sizes, F.lit(0), lambda a, n: a + n) > total, "conversation_too_long")
        .when(F.exists(messages, lambda m: ~m["role"].isin("user", "assistant")), "bad_role")
    )


def multiple_choice(question: Column, letters: Column, choices: Column) -> Column:
    """A multiple-choice prompt with the letter after each choice."""
    lines = F.array_join(F.zip_with(letters, choices, lambda l, c: F.concat(F.lit("- "), c, F.lit("="), l, F.lit("\n"))), "")
    return F.concat(F.lit("Multiple Choice question: "), question, F.lit("\n"), lines, F.lit("\nRespond only with the letter of the correct answer."))


def few_shot(examples: Column, query: Column) -> Column:
    """Solved examples, each followed by a blank line, then the query."""
    return F.concat(F.array_join(F.transform(examples, lambda e: F.concat(e, F.lit("\n\n"))), ""), query)


def choice_prompts(query: Column, choices: Column, delimiter: Column, examples: Column) -> Column:
    """One prompt a choice."""
    return F.transform(choices, lambda c: few_shot(examples, F.concat(query, delimiter, c)))


def schema_prompts(contexts: Column, continuation: Column, delimiter: Column, examples: Column) -> Column:
    """One prompt a context."""
    return F.transform(contexts, lambda c: few_shot(examples, F.concat(c, delimiter, continuation)))


def completion_prompts(context: Column, continuation: Column, delimiter: Column, examples: Column) -> Column:
    """The prompt without the continuation (trimmed) and with it."""
    bare = F.concat(F.trim(context), delimiter)
    return F.array(F.trim(few_shot(examples, bare)), few_shot(examples, F.concat(bare, continuation)))
