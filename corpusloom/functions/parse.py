"""Parsers of what language models write: question-answer lists, option letters, selections; and of chats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import strip

# Schemas, and the words before an answer.
PAIR_SCHEMA = "array<struct<instruction string, input string, output string, type string>>"
MESSAGES_SCHEMA = "array<struct<role string, content string>>"
ANSWER_WORDS = r"(?i)^(The\s+)?(correct\s+)?(answer|answers?)\s*(is|are|:)\s*"
# Letters in a list, a letter that begins a line, and letters that are no part of words.
LISTED_LETTERS = r"^([A-Z](?:\s*(?:,|;|&|\band\b)\s*[A-Z])+)\b"
FIRST_LETTER = r"^([A-Z])(?:\.|,|\s|$)"
LONE_LETTERS = r"(?<![A-Za-z])([A-Z])(?![a-z])"


def qa_pairs(reply: Column, least_instruction: int = 10, least_output: int = 50) -> Column:
    """The valid pairs of a reply, null if there are none: code fences go, else the outermost brackets are tried; only
    lists count; too short instructions and outputs go; types are upper-cased."""
    # a lambda's variable is computed once, wherever and how often its body uses it
    let = lambda value, body: F.transform(F.array(value), body)[0]
    text = F.regexp_replace(F.regexp_replace(strip(reply), r"^```[^\n]*\n", ""), r"\s*```$", "")

    def parsed(text: Column) -> Column:
        inner = let(F.regexp_extract(text, r"(?s)\[.*\]", 0), lambda x: F.from_json(F.when(x != "", x), PAIR_SCHEMA))
        return F.coalesce(F.when(F.startswith(text, F.lit("[")), F.from_json(text, PAIR_SCHEMA)), F.when(~F.startswith(text, F.lit("{")), inner))

    tidy = F.transform(
        let(text, parsed),
        lambda p: F.struct(
            strip(p["instruction"]).alias("instruction"),
            F.coalesce(strip(p["input"]), F.lit("")).alias("input"),
            strip(p["output"]).alias("output"),
            F.coalesce(F.upper(strip(p["type"])), F.lit("UNKNOWN")).alias("type"),
        ),
    )
    valid = F.filter(tidy, lambda p: (F.char_length(p["instruction"]) >= least_instruction) & (F.char_length(p["output"]) >= least_output))
    return let(valid, lambda v: F.when(F.size(v) > 0, v))


def _letters(text: Column, valid: Column | None) -> Column:
    """The distinct capitals of a text in order, only the valid ones if they are given."""
    found = F.array_sort(F.array_distinct(F.regexp_extract_all(text, F.lit("([A-Z])"), F.lit(1))))
    if valid is not None:
        found = F.filter(found, lambda x: F.array_contains(valid, x) | valid.isNull())
    return F.array_join(found, "")


def answer_letters(reply: Column, valid: Column | None = None, drop_thoughts: bool = True) -> Column:
    """The option letters that a reply means, or the empty text.

    Tried in this order: a first word of capitals only; a list of single capitals; a single capital with a full stop,
    comma or white space; capitals that are no part of words. ``valid`` is an array column of option letters.
    """
    text = F.coalesce(reply, F.lit(""))
    if drop_thoughts:
        text = F.regexp_replace(text, r"(?s)<think>.*?</think>", "")
    text = strip(text)
    first = F.regexp_replace(F.regexp_extract(text, r"^\S+", 0), r"[.,;:!]+$", "")
    compact = F.when(first.rlike(r"^[A-Z]{2,}$"), _letters(first, valid))
    line = F.regexp_replace(strip(F.regexp_extract(text, r"^[^\n]*", 0)), ANSWER_WORDS, "")
    listed = _letters(F.regexp_replace(F.regexp_extract(line, LISTED_LETTERS, 1), "and", ""), valid)
    single = _letters(F.regexp_extract(line, FIRST_LETTER, 1), valid)
    alone = _letters(F.array_join(F.regexp_extract_all(line, F.lit(LONE_LETTERS), F.lit(1)), ""), valid)
    filled = lambda c: F.when(c != "", c)
    return F.coalesce(filled(compact), filled(listed), filled(single), alone)


def selection(reply: Column, k: int = 3, pool: int = 66) -> Column:
    """The ``k`` numbers that a reply selects: its JSON list if that has exactly k, else the first k distinct numbers
    below ``pool`` in the text; null if there are fewer."""
    listed = F.from_json(F.regexp_extract(reply, r"(?s)\"selected\"\s*:\s*(\[[^\]]*\])", 1), "array<int>")
    loose = F.array_distinct(F.transform(F.regexp_extract_all(reply, F.lit(r"\b(\d{1,9})\b"), F.lit(1)), lambda x: x.cast("int")))
    loose = F.slice(F.filter(loose, lambda x: x < pool), 1, k)
    return F.when((F.size(listed) == k) & ~F.exists(listed, lambda x: x.isNull()), listed).when(F.size(loose) == k, loose)


def decoded_messages(messages: Column) -> Column:
    """Chat messages of a JSON text, null if it is none."""
    return F.from_json(messages, MESSAGES_SCHEMA)


def first_turn(messages: Column) -> Column:
    """The first complete turn of a chat as ``instruction``, ``input`` and ``output``, or null.

    Blank messages don't count. The last system message before the first user message comes before its text; the answer
    is the first assistant message behind it.
    """
    said = F.filter(F.transform(messages, lambda m: F.struct(m["role"].alias("role"), strip(m["content"]).alias("content"))), lambda m: m["content"] != "")
    user_at = F.array_position(F.transform(said, lambda m: m["role"]), "user").cast("int")
    before, after = F.slice(said, F.lit(1), F.greatest(user_at - 1, F.lit(0))), F.slice(said, F.greatest(user_at, F.lit(1)), F.size(said))
    pick = lambda part, role, at: F.try_element_at(F.filter(part, lambda m: m["role"] == role), F.lit(at))["content"]
    system, user, answer = pick(before, "system", -1), pick(after, "user", 1), pick(after, "assistant", 1)
    instruction = F.concat(F.coalesce(F.concat(system, F.lit("\n\n")), F.lit("")), user)
    return F.when((user_at > 0) & answer.isNotNull(), F.struct(instruction.alias("instruction"), F.lit("").alias("input"), answer.alias("output")))


def chat_gate(turn: Column) -> Column:
    """Whether a turn's texts have acceptable lengths."""
    return F.coalesce((F.char_length(turn["instruction"]) >= 10) & F.char_length(turn["output"]).between(20, 8000), F.lit(False))


def options_text(options: Column) -> Column:
    """The options of a question in order, a line each."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(options)), lambda e: F.concat(e["key"], F.lit(". "), e["value"])), "\n")


def question_prompt(question: Column, options: Column, passages: Column | None = None, most: int = 1500) -> Column:
    """A question with its options, behind numbered passages of ``most`` characters each if there are any."""
    body = F.concat(F.lit("Question: "), question, F.lit("\n"), options_text(options), F.lit("\nAnswer:"))
    if passages is None:
        return body
    numbered = F.transform(passages, lambda p, i: F.concat(F.lit("["), (i + 1).cast("string"), F.lit("] "), F.substring(p, 1, most)))
    return F.concat(F.array_join(numbered, "\n\n"), F.lit("\n\n"), body)


def _asked(question: Column, options: Column, answer: Column) -> Column:
    return F.concat(F.lit("\nQuestion: "), question, F.lit("\n"), options_text(options), F.lit("\n\nAnswer:"), answer)


def solved_example(question: Column, options: Column, answer: Column) -> Column:
    """A question with its options and the letters (an array) of its answer in order."""
    return _asked(question, options, F.concat(F.lit(" "), F.array_join(F.array_sort(answer), "")))


def exam_prompt(instruction: str, question: Column, options: Column, examples: Column | None = None) -> Column:
    """An instruction, solved examples (an array) if there are any, and the question."""
    asked = _asked(question, options, F.lit(""))
    if examples is None:
        return F.concat_ws("\n", F.lit(instruction), asked)
    return F.concat_ws("\n", F.lit(instruction), examples, asked)


def filled(template: str, **values: Column) -> Column:
    """A template with columns in the place of their names in braces; nulls are empty. A value's own braces stay as they are."""
    parts, rest = [], template
    while names := [n for n in values if f"{{{n}}}" in rest]:
        name = min(names, key=lambda n: rest.index(f"{{{n}}}"))
        before, _, rest = rest.partition(f"{{{name}}}")
        parts += [F.lit(before), F.coalesce(values[name].cast("string"), F.lit(""))]
    return F.concat(*parts, F.lit(rest))


def candidate_line(number: Column, amounts: dict[str, Column]) -> Column:
    """A candidate's line: its number in two places, and amounts with two digits behind the point under their names."""
    shown = "  #%2d: " + ", ".join(f"{name}=%.2f" for name in amounts)
    return F.format_string(shown, number, *amounts.values())


def in_lines(line: Column, order: Column) -> Column:
    """Aggregate: the lines of a group in order, for groups of few rows as a prompt has them."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), line.alias("l")))), lambda x: x["l"]), "\n")
