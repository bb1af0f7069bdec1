"""Personal data by patterns, checksum validators and context, in DataFrame expressions only.

Patterns propose spans; validators (octet range, digit counts, Luhn, mod 97)
confirm them; words near a span move its score.  Everything is row-local: no
shuffle, no Python.  Kinds `email`, `ip`, `card` and `phone` are the base and are
kept whatever their score; `iban` must pass mod 97 and `id` must reach
``MIN_SCORE`` through its context.

Patterns are written for Java so that they take linear time on any text: runs are
possessive, and a look-behind keeps a match from starting inside a run in which it
could not have started anyway (``\\G`` is the end of the match before).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOCAL = "A-Za-z0-9._%+-"
#: kind, pattern
PATTERNS: tuple[tuple[str, str], ...] = (
    ("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,}+"),
    ("phone", r"\+[0-9][ ().0-9-]+[0-9]"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){2,7}+(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30}+)(?![A-Za-z0-9])"),
    ("id", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
)
KINDS = tuple(k for k, _ in PATTERNS)
BASE_KINDS = ("email", "ip", "card", "phone")
#: Score of a confirmed span before its context is read, and what a context word adds or takes away.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.9, "phone": 0.7, "iban": 0.9, "id": 0.4}
SUPPORT = {
    "email": r"mail|contact|address|write to",
    "ip": r"\bip\b|address|host|server|login",
    "card": r"card|credit|debit|visa|master|amex|payment",
    "phone": r"phone|tel\b|call|mobile|fax|contact",
    "iban": r"iban|bank|account|transfer|konto|compte|cuenta",
    "id": r"ssn|social security|tax id|passport|identity",
}
AGAINST = r"version|isbn|serial|order no|part no|example only"
CONTEXT_CHARS, GAIN, LOSS, MIN_SCORE = 48, 0.3, 0.3, 0.5


def luhn(digits: Column) -> Column:
    """True if a string of digits passes Luhn's checksum."""
    n = F.length(digits)

    def value(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda total, i: total + value(i)) % 10 == 0


def mod97(account: Column) -> Column:
    """True if an account number without spaces, its first four characters moved to the end, is 1 modulo 97."""
    moved = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))

    def step(total: Column, c: Column) -> Column:
        value = F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (total * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def _octets(span: Column) -> Column:
    """True if no part is above 255, whatever zeros lead it."""

    def fits(part: Column) -> Column:
        value = F.ltrim(part, F.lit("0"))
        return (F.length(value) <= 3) & (F.lpad(value, 3, "0") <= "255")

    return F.forall(F.split(span, "[.]"), fits)


def _confirmed(kind: str, span: Column) -> Column:
    digits = F.regexp_replace(span, "[^0-9]", "")
    match kind:
        case "ip":
            return _octets(span)
        case "card":
            return F.length(digits).between(16, 19) & luhn(digits)
        case "phone":
            return F.length(digits).between(8, 15)
        case "iban":
            return F.length(F.translate(span, " ", "")).between(15, 34) & mod97(F.translate(span, " ", ""))
        case "id":
            return ~F.substring(span, 1, 3).isin("000", "666") & (F.substring(span, 1, 1) != "9") & (F.substring(span, 5, 2) != "00") & (F.substring(span, 8, 4) != "0000")
    return F.lit(True)


#: Numbers of a list's blocks for sums and maxima of all before an item: linear time in effect, where slices from the start are quadratic.
_BLOCK = 64
#: Matches on each side of a span whose text can lie within its context; a match has four characters or more.
_BESIDE = CONTEXT_CHARS // 4 + 1


def _bound(value: Column, use) -> Column:
    """use(value) with the value named once: an element of a one-element array."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda total, x: total + x)


def _running(values: Column, total, both) -> Column:
    """For each value the total of all values before it, 0 for none."""
    indexes = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.expr("CAST(array() AS array<int>)"))
    none = F.lit(0)

    def run(values: Column) -> Column:
        blocks = F.transform(indexes(F.ceil(F.size(values) / _BLOCK).cast("int")), lambda b: total(F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK))))
        earlier = lambda blocks: F.transform(indexes(F.size(blocks)), lambda b: F.when(b > 0, total(F.slice(blocks, F.lit(1), b))).otherwise(none))
        inside = lambda i: F.when(i % _BLOCK > 0, total(F.slice(values, i - i % _BLOCK + 1, i % _BLOCK))).otherwise(none)
        return _bound(_bound(blocks, earlier), lambda sums: F.transform(indexes(F.size(values)), lambda i: both(F.get(sums, F.floor(i / _BLOCK).cast("int")), inside(i))))

    return _bound(values, run)


def _spans_of(kind: str, pattern: str, text: Column) -> Column:
    """array<struct<kind, start, end, score>> of one kind's confirmed spans.

    split() gives the text between the matches, so a match's start is the length of
    all matches and gaps before it.  Its context is read from the matches and gaps beside it.
    """
    empty = F.expr("CAST(array() AS array<struct<kind:string,start:int,end:int,score:double>>)")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    last, first = lambda s: F.right(s, F.lit(CONTEXT_CHARS)), lambda s: F.left(s, F.lit(CONTEXT_CHARS))

    def located(pair: Column) -> Column:
        found, gaps = pair["found"], pair["gaps"]
        at = F.sequence(F.lit(0), F.size(found) - 1)
        # what lies before match i, from match i - 1 on, and after it, to match i + 1
        before = F.transform(at, lambda i: last(F.concat(F.when(i > 0, F.get(found, i - 1)).otherwise(""), F.get(gaps, i))))
        after = F.transform(at, lambda i: first(F.concat(F.get(gaps, i + 1), F.coalesce(F.get(found, i + 1), F.lit("")))))
        steps = F.transform(at, lambda i: F.length(F.get(gaps, i)) + F.length(F.get(found, i)))
        sides = F.struct(before.alias("before"), after.alias("after"), _running(steps, _sum, lambda a, b: a + b).alias("passed"))

        def spans(sides: Column) -> Column:
            def scored(i: Column) -> Column:
                start = F.get(sides["passed"], i) + F.length(F.get(gaps, i))
                low = F.greatest(i - _BESIDE, F.lit(0))
                near = F.lower(F.concat(last(F.array_join(F.slice(sides["before"], low + 1, i - low + 1), "")), F.lit(" "), first(F.array_join(F.slice(sides["after"], i + 1, F.lit(_BESIDE + 1)), ""))))
                score = F.lit(PRIOR[kind]) + F.when(near.rlike(SUPPORT[kind]), GAIN).otherwise(0.0) - F.when(near.rlike(AGAINST), LOSS).otherwise(0.0)
                return F.struct(F.lit(kind).alias("kind"), start.cast("int").alias("start"), (start + F.length(F.get(found, i))).cast("int").alias("end"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)).alias("score"))

            return F.transform(F.filter(at, lambda i: _confirmed(kind, F.get(found, i))), scored)

        out = _bound(sides, spans)
        return out if kind in BASE_KINDS else F.filter(out, lambda s: s["score"] >= MIN_SCORE)

    pairs = F.struct(found.alias("found"), F.split(text, pattern, -1).alias("gaps"))
    return F.when(F.size(found) > 0, _bound(pairs, located)).otherwise(empty)


def find_spans(text: Column) -> Column:
    """All spans of a text, by kind as in KINDS and then start; code points, end exclusive; null: none."""
    value = F.coalesce(text, F.lit(""))
    return F.concat(*(_spans_of(kind, pattern, value) for kind, pattern in PATTERNS))


#: Characters of the pieces that a text is cut into, as a substring takes time in proportion to its distance from the start.
_PIECE = 1024


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans become one, named after the first.

    Before a Python function reads the result, shared.apart() must keep it in a projection of its own.
    """
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    pieces = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{_PIECE}}}"), F.lit(0))
    reached = lambda ordered: _running(F.transform(ordered, lambda s: s["end"]), F.array_max, F.greatest)

    def replaced(ordered: Column) -> Column:
        """Spans that begin at or behind the end of all before them, each with that end; it is where the text goes on."""
        known = F.arrays_zip(ordered.alias("span"), reached(ordered).alias("passed"))
        return F.filter(known, lambda x: x["span"]["start"] >= x["passed"])

    def out(parts: Column) -> Column:
        pieces, shown, end = parts["pieces"], parts["shown"], parts["end"]

        def between(a: Column, b: Column) -> Column:
            low, high = F.floor(a / _PIECE).cast("int"), F.floor((b - 1) / _PIECE).cast("int")
            cut = lambda k: F.substring(F.get(pieces, k), F.greatest(a - k * _PIECE, F.lit(0)) + 1, F.least(b - k * _PIECE, F.lit(_PIECE)) - F.greatest(a - k * _PIECE, F.lit(0)))
            return F.when(b > a, F.array_join(F.transform(F.sequence(low, high), cut), "")).otherwise("")

        marked = F.transform(shown, lambda x: F.concat(between(x["passed"], x["span"]["start"]), F.lit("["), F.upper(x["span"]["kind"]), F.lit("]")))
        return F.concat(F.array_join(marked, ""), between(end, parts["length"]))

    def done(ordered: Column) -> Column:
        end = F.array_max(F.transform(ordered, lambda s: s["end"]))
        return _bound(F.struct(pieces.alias("pieces"), replaced(ordered).alias("shown"), end.alias("end"), F.length(text).alias("length")), out)

    return F.when(F.size(spans) > 0, _bound(ordered, done)).otherwise(text)


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and its spans (array<struct<kind, start, end, score>>) for every row; null or empty texts have none.

    Repeated rows and null ids stay; an empty table gives no rows; texts of any length, of any number of spans, take time
    in proportion to both; other columns aren't read, whatever their names.
    """
    return docs.select(F.col(doc_id).alias("doc_id"), find_spans(F.col(text)).alias("spans"))


def span_digest(found: DataFrame) -> DataFrame:
    """Counts, hash and list of the spans that personal_data() found."""
    named = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select("doc_id", *(count(k) for k in KINDS), F.sha2(named(base), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))
