r"""Personal data in texts, with DataFrame functions only.

Regular expressions propose spans, checksums confirm them (Luhn for cards, mod-97 for account numbers,
ranges for addresses), and words near a span raise or lower its score. The expressions never go back over
what they have matched (possessive repeats, a look at the character before), so a text is read in time
proportional to its length.

Spans come from marking: each match is put between two marks, the text is split at them, and the lengths
of the parts add up to offsets in code points. Contexts come from neighbouring parts and not from the
text, as a substring is found by walking the text from its start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The base kinds in their order, then the kinds that the method adds.
BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "short_card")

MARK, OTHER = "\u0001", "\u0002"  # the mark, and what stands for it where a text has it
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
HINTS = {  # cheap conditions without which a text has no match
    "email": "contains(text, '@')",
    "ip": r"text RLIKE '[0-9]\\.[0-9]++\\.[0-9]'",
    "card": r"text RLIKE '[0-9](?:[\\x20-]?+[0-9]){12}'",
    "phone": "contains(text, '+')",
    "iban": r"text RLIKE '[A-Z]{2}[0-9]{2}[\\x20A-Z0-9]{11}'",
    "ssn": r"text RLIKE '[0-9]-[0-9]{2}-[0-9]'",
}
BEFORE, AFTER = 40, 20  # code points around a span in which context words count
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.4, "short_card": 0.4}
CONTEXT = {  # words that raise a score, and words that lower it
    "email": ("e-?mail|contact|mail to|write to|courriel|correo", "example|noreply|no-reply"),
    "ip": ("ip|address|host|server|client|login|adresse|dirección", "version|release|section|v\\\\.|chapter"),
    "card": ("card|visa|master|amex|credit|payment|karte|carte|tarjeta", "order|invoice|isbn|tracking|serial"),
    "phone": ("phone|call|tel|mobile|fax|contact|telefon|téléphone|teléfono", "serial|version|order"),
    "iban": ("iban|account|bank|konto|compte|cuenta", "serial|hash|checksum"),
    "ssn": ("ssn|social security|tax ?id|insurance number", "serial|part|order|model"),
}
CONTEXT["short_card"] = CONTEXT["card"]
RAISE, LOWER, LEAST = 0.3, 0.3, 0.6

_DIGITS = "regexp_replace(x.value, '[^0-9]', '')"


def _parts(kind: str) -> str:
    """SQL of a text cut at the matches of a kind: gap, match, gap, match and so on; empty where it has none."""
    pattern = PATTERNS[kind].replace("\\", "\\\\").replace("'", "\\'")
    return (f"CASE WHEN {HINTS[kind]} THEN split(regexp_replace(translate(text, '{MARK}', '{OTHER}'), '{pattern}', "
            f"'{MARK}$0{MARK}'), '{MARK}') ELSE cast(array() AS array<string>) END")


def _blocks(values: str, item: str) -> str:
    """SQL of an array (a column's name) as about sqrt(n) blocks of about sqrt(n) items, each ``item`` of its element ``v``."""
    width = f"cast(ceil(sqrt(size({values}))) AS int)"
    return f"""CASE WHEN size({values}) > 0 THEN transform(sequence(0, cast((size({values}) - 1) div {width} AS int)),
        b -> transform(slice({values}, b * {width} + 1, {width}), v -> {item})) ELSE cast(array() AS array<array<int>>) END"""


def _before(blocks: str, combine: str) -> str:
    """SQL of what ``combine`` (of ``x`` and ``y``) makes of all items before each one, from 0, over ``_blocks``.

    An array is copied when it grows by one, so a fold over all n items would take n * n steps. Blocks
    are folded by themselves from what lies before them: n * sqrt(n) steps.
    """
    def fold(items: str, start: str, item: str) -> str:
        step = combine.replace("x", "a.at").replace("y", item)
        return (f"aggregate({items}, named_struct('at', {start}, 'out', cast(array() AS array<int>)), (a, i) -> "
                f"named_struct('at', {step}, 'out', array_append(a.out, a.at)), a -> a.out)")
    whole = f"aggregate(i, 0, (s, j) -> {combine.replace('x', 's').replace('y', 'j')})"
    return f"flatten(zip_with({blocks}, {fold(blocks, '0', whole)}, (items, start) -> {fold('items', 'start', 'i')}))"


def _matches(kind: str) -> str:
    """SQL of the matches of a kind from its parts: an array of (start, stop, value, part), part its index from 0."""
    part = f"get(parts_{kind}, i)"
    return f"""filter(transform({_before(f'lengths_{kind}', 'x + y')}, (s, i) -> CASE WHEN i % 2 = 1 THEN named_struct(
        'start', s, 'stop', s + char_length({part}), 'value', {part}, 'part', i) END), x -> x IS NOT NULL)"""


def _luhn(digits: str) -> str:
    digit = "cast(substring(reverse(d), i, 1) AS int)"
    return f"""aggregate(sequence(1, length({digits})), 0, (s, i) -> s + CASE WHEN i % 2 = 1 THEN {digit}
        ELSE 2 * {digit} - CASE WHEN {digit} > 4 THEN 9 ELSE 0 END END, s -> s % 10 = 0)""".replace("(d)", f"({digits})")


def _mod97(value: str) -> str:
    code = "ascii(substring(v, i, 1))"
    return f"""aggregate(sequence(1, length({value})), 0L, (m, i) -> CASE WHEN {code} >= 65 THEN (m * 100 + {code} - 55) % 97
        ELSE (m * 10 + {code} - 48) % 97 END, m -> m = 1)""".replace("(v,", f"({value},")


_IBAN = "concat(substring(replace(x.value, ' ', ''), 5), substring(x.value, 1, 4))"
VALID = {
    "email": "true",
    "ip": "forall(split(x.value, '[.]'), p -> length(ltrim('0', p)) <= 3 AND coalesce(cast(nullif(ltrim('0', p), '') AS int), 0) <= 255)",
    "card": f"length({_DIGITS}) BETWEEN 16 AND 19 AND {_luhn(_DIGITS)}",
    "phone": f"length({_DIGITS}) BETWEEN 8 AND 15",
    "iban": _mod97(_IBAN),
    "ssn": "substring(x.value, 1, 3) NOT IN ('000', '666') AND substring(x.value, 1, 1) <> '9' "
           "AND substring(x.value, 5, 2) <> '00' AND substring(x.value, 8) <> '0000'",
    "short_card": f"length({_DIGITS}) BETWEEN 13 AND 15 AND {_luhn(_DIGITS)}",
}


def _scored(kind: str) -> str:
    """SQL of the confirmed spans of a kind with their scores."""
    found = "card" if kind == "short_card" else kind
    # a match has two code points or more, so that many parts hold the context
    before = f"slice(parts_{found}, greatest(x.part - {BEFORE + 1}, 0) + 1, least({BEFORE + 1}, x.part))"
    after = f"slice(parts_{found}, x.part + 2, {AFTER + 1})"
    near = (f"lower(concat(right(array_join(transform({before}, p -> right(p, {BEFORE})), ''), {BEFORE}), ' ', "
            f"left(array_join(transform({after}, p -> left(p, {AFTER})), ''), {AFTER})))")
    up, down = CONTEXT[kind]
    score = (f"get(transform(array({near}), w -> greatest(0D, least(1D, {PRIOR[kind]}D + CASE WHEN w RLIKE '\\\\b(?:{up})' "
             f"THEN {RAISE}D ELSE 0D END - CASE WHEN w RLIKE '\\\\b(?:{down})' THEN {LOWER}D ELSE 0D END))), 0)")
    return (f"transform(filter(found_{found}, x -> {VALID[kind]}), x -> named_struct('kind', '{kind}', 'start', x.start, "
            f"'stop', x.stop, 'score', {score}))")


def find_pii(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """``docs`` (any columns, text among them) with ``pii``: an array of (kind, start, stop, score), by kind, then start.

    Offsets are in code points, ends exclusive. Base kinds (email, ip, card, phone) always stay once
    confirmed; the others only with a score of at least ``least``. Spans of different kinds may overlap.
    A null text has none. A column named ``pii`` is replaced; rows are kept as they are.
    """
    keep = [F.col(f"`{c}`") for c in docs.columns if c != "pii"]
    # all columns of the input go into one, so that no name of theirs meets one of these
    found = docs.select(F.struct(*keep).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    parts = [f"parts_{k}" for k in PATTERNS]
    found = found.select("row", *(F.expr(_parts(k)).alias(f"parts_{k}") for k in PATTERNS))
    found = found.select("row", *parts, *(
        F.expr(_blocks(f"parts_{k}", "char_length(v)")).alias(f"lengths_{k}") for k in PATTERNS))
    found = found.select("row", *parts, *(F.expr(_matches(k)).alias(f"found_{k}") for k in PATTERNS))
    every = ", ".join(_scored(k) if k in BASE else f"filter({_scored(k)}, x -> x.score >= {least}D)" for k in (*BASE, *ADDED))
    return found.select("row", F.expr(f"concat({every})").alias("pii")).select("row.*", "pii")


def spans_sql(spans: str) -> str:
    return f"concat_ws(',', transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.stop)))"


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for each row of ``docs``."""
    kinds = ", ".join(f"'{k}'" for k in BASE)
    return find_pii(docs.select("doc_id", "text")).selectExpr(
        "doc_id", *(f"cast(size(filter(pii, x -> x.kind = '{k}')) AS long) AS n_{k}" for k in BASE),
        f"sha2({spans_sql(f'filter(pii, x -> x.kind IN ({kinds}))')}, 256) AS base_sha256", f"{spans_sql('pii')} AS spans")


CHUNK = 1024  # code points in a piece of a text from which stretches of it are cut


def _cut(start: str, stop: str) -> str:
    """SQL of the code points from ``start`` to ``stop`` of a text in ``chunks``; reads no more than the chunks they lie in."""
    first = f"cast({start} div {CHUNK} AS int)"
    return (f"substring(array_join(slice(chunks, {first} + 1, cast(({stop} - 1) div {CHUNK} AS int) - {first} + 1), ''), "
            f"{start} - {first} * {CHUNK} + 1, {stop} - {start})")


def redact(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """``docs`` with each span of personal data replaced by its kind in brackets; overlapping spans by the first one's.

    ``n_chars``, if there, is counted again. A null text stays null.
    """
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in ("pii", "text")]
    found = find_pii(docs, least).select(F.struct(*keep, F.lit(0).alias("__any")).alias("row"), "text", F.expr(
        "array_sort(transform(pii, x -> named_struct('start', x.start, 'stop', x.stop, 'kind', x.kind)))").alias("spans"))
    some = "size(spans) > 0"
    found = found.selectExpr("row", "text", "spans", f"{_blocks('spans', 'v.stop')} AS stops", f"""CASE WHEN {some}
        THEN regexp_extract_all(text, '(?s).{{1,{CHUNK}}}', 0) ELSE cast(array() AS array<string>) END AS chunks""")
    found = found.selectExpr("row", "text", "spans", "chunks", f"{_before('stops', 'greatest(x, y)')} AS done")
    # each span that starts behind all earlier ones gives what lies between and its kind
    pieces = f"""array_join(transform(spans, (x, i) -> CASE WHEN x.start >= get(done, i)
        THEN concat({_cut('get(done, i)', 'x.start')}, '[', upper(x.kind), ']') ELSE '' END), '')"""
    last = "array_max(transform(spans, x -> x.stop))"
    rest = f"array_join(transform(array({last}), e -> {_cut('e', f'size(chunks) * {CHUNK}')}), '')"
    found = found.selectExpr("row", f"CASE WHEN {some} THEN concat({pieces}, {rest}) ELSE text END AS text")
    found = found.select("row.*", "text").drop("__any")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(
            F.char_length("text")).cast(kind))
    return found.select(*(f"`{c}`" for c in docs.columns if c != "pii"))
