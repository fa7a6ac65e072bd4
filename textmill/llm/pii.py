"""Personal data: regular expressions propose spans, checksums confirm, context words score.

All of it is column expressions. Positions come from splitting a text at a pattern's
matches: the lengths of the gaps and of the matches, summed up, are code point offsets.
Repeated groups in the patterns are possessive, which changes no match here (what follows a
group cannot start with what the group takes) and keeps the matcher's stack flat on very
long runs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, table


@dataclass(frozen=True)
class Kind:
    """What is proposed (``pattern``), where it is worth looking (``hint``), how it is scored.

    ``base`` is the score of a span that the validator confirms, ``context`` the words that
    add ``CONTEXT`` to it when one is within WINDOW code points before it.
    """

    name: str
    pattern: str
    hint: str
    base: float
    context: str = ""


#: The patterns of the contract, then those that the method adds.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, "mail|contact|courriel|correo"),
    Kind("ip", r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", 0.7, "ip|address|server|host|login"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "", 0.8, "card|visa|credit|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.8, "phone|tel|call|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "", 0.9, "iban|account|konto|compte|cuenta"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", 0.3, "ssn|social|security"),
    Kind("secret", r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,64}+|gh[opsu]_[A-Za-z0-9]{36}|AKIA[0-9A-Z]{16}|sk-[A-Za-z0-9]{20,64}+)(?![A-Za-z0-9])", "", 0.3, "token|secret|key|passw|auth|credential"),
)
BASE = ("email", "ip", "card", "phone")
CONTEXT, WINDOW, LEAST = 0.3, 40, 0.5
#: A proposed match has two code points or more, so this many before a match cover its window.
PIECES = WINDOW // 2
#: Values that a running result is appended to one by one, and code points that are cut at a time.
BLOCK, CUT = 64, 4096


def digits(text: Column) -> Column:
    """The digits 0 to 9 of a short text."""
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Luhn's check of a digit string: every second digit from the right counts double."""
    values = F.transform(F.split(F.reverse(number), ""), lambda d: d.cast("int"))
    shares = F.transform(
        values,
        lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2),
    )
    return F.aggregate(shares, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(account: Column) -> Column:
    """The mod-97 check of an account number: its first four characters moved to the end, A = 10."""
    moved = F.concat(F.substring(account, 5, 100), F.substring(account, 1, 4))
    values = F.transform(F.split(moved, ""), lambda c: F.conv(c, 36, 10).cast("int"))
    rest = F.aggregate(values, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97)
    return rest == 1


def running(values: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Of each value what ``step`` makes of ``start`` and the values before it; ``step`` is associative."""

    def short(part: Column, begin: Column) -> Column:
        state = F.struct(begin.alias("at"), F.expr("cast(array() as array<int>)").alias("out"))
        return F.aggregate(part, state, lambda acc, v: F.struct(step(acc.at, v).alias("at"), F.concat(acc.out, F.array(acc.at)).alias("out")), lambda acc: acc.out)

    def long(parts: Column) -> Column:
        totals = F.transform(parts, lambda part: F.aggregate(part, start, step))
        return F.flatten(F.zip_with(parts, short(totals, start), short))

    def of(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")), lambda b: F.slice(v, b * BLOCK + 1, F.lit(BLOCK)))
        return F.when(F.size(v) <= BLOCK, short(v, start)).otherwise(let(blocks, long))

    return let(values, of)


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        parts = F.split(match, r"\.")
        short = F.transform(parts, lambda p: F.regexp_replace(p, "^0+(?=.)", ""))
        return F.forall(short, lambda p: (F.length(p) <= 3) & (p.cast("int") <= 255))
    if kind == "card":
        number = digits(match)
        return F.when(F.length(number).between(14, 19), luhn(number)).otherwise(False)
    if kind == "phone":
        return F.length(digits(match)).between(10, 15)
    if kind == "iban":
        account = F.replace(match, F.lit(" "), F.lit(""))
        return F.when(F.length(account).between(15, 34), mod97(account)).otherwise(False)
    if kind == "ssn":
        return ~match.rlike("^(000|666|9)") & ~match.rlike("-00-|-0000$")
    if kind == "secret":
        return F.size(F.array_distinct(F.split(match, ""))) >= 8  # no filler of a few signs
    return F.lit(True)


def _kind_spans(text: Column, order: int, kind: Kind) -> Column:
    """Confirmed spans of one kind: array of struct(start, kind_order, kind, end, score)."""
    schema = "array<struct<start:int,kind_order:int,kind:string,end:int,score:double>>"
    gaps = F.transform(F.split(text, kind.pattern, -1), lambda g: F.struct(F.length(g).alias("gap"), F.right(g, F.lit(WINDOW)).alias("tail")))
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    zipped = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, m: F.struct(g.gap.alias("gap"), g.tail.alias("tail"), m.alias("match"), (g.gap + F.length(m)).alias("width")))

    def placed(found: Column) -> Column:
        ends_before = running(F.transform(found, lambda z: z.width), F.lit(0), lambda a, w: a + w)
        all_pieces = F.transform(found, lambda z: F.concat(z.tail, z.match))

        def one(z: Column, k: Column, before: Column, pieces: Column) -> Column:
            # The code points before a match run on through the matches before it.
            near = F.concat(F.array_join(F.slice(pieces, F.greatest(k - PIECES, F.lit(0)) + 1, F.least(k, F.lit(PIECES))), ""), z.tail)
            return F.struct((before + z.gap).alias("start"), (before + z.width).alias("end"), z.match.alias("match"), F.right(near, F.lit(WINDOW)).alias("near"))

        return let(ends_before, lambda before: let(all_pieces, lambda pieces: F.transform(found, lambda z, k: one(z, k, F.get(before, k), pieces))))

    keep = lambda z: _valid(kind.name, z.match)
    score = lambda z: F.lit(kind.base) + (F.when(z.near.rlike(rf"(?i)\b(?:{kind.context})"), CONTEXT).otherwise(0.0) if kind.context else 0.0)
    spans = F.transform(
        F.filter(let(zipped, placed), keep),
        lambda z: F.struct(
            z.start.alias("start"), F.lit(order).alias("kind_order"), F.lit(kind.name).alias("kind"), z.end.alias("end"), F.least(score(z), F.lit(1.0)).cast("double").alias("score")
        ),
    )
    if kind.name not in BASE:
        spans = F.filter(spans, lambda s: s.score >= LEAST)
    # Most texts have nothing of a kind; the test is far cheaper than the split.
    maybe = text.rlike(kind.pattern) if not kind.hint else text.contains(kind.hint) & text.rlike(kind.pattern)
    return F.when(maybe, spans).otherwise(F.lit(None)).cast(schema)


def personal_spans(text: Column) -> Column:
    """All confirmed spans of a text by start, then kind: array of struct(start, kind_order, kind, end, score).

    Offsets are code points, ends exclusive. A null or empty text has none. Spans of one kind
    do not overlap; spans of different kinds may, and of those that start together the kind
    listed first comes first. Kinds that the method adds count from a score of LEAST; the four
    base kinds always count. Texts of any length are read whole. A text's spans do not
    depend on other rows, so repeated rows have the same.
    """
    text = F.coalesce(text, F.lit(""))
    empty = F.expr("cast(array() as array<struct<start:int,kind_order:int,kind:string,end:int,score:double>>)")
    return F.array_sort(F.concat(*[F.coalesce(_kind_spans(text, k, kind), empty) for k, kind in enumerate(KINDS)]))


def find_personal_data(docs: DataFrame, out: str = "pii") -> DataFrame:
    """``docs`` (with a column text) and its personal spans in the column ``out``, which must be a free name.

    An empty table gives no rows; other columns stay as they are.
    """
    return docs.withColumn(out, personal_spans(F.col("text")))


def stretches(spans: Column) -> Column:
    """Spans, sorted by start, with those that overlap joined: array of struct(start, end, kind of the first)."""
    reach = running(F.transform(spans, lambda s: s.end), F.lit(0), lambda a, e: F.greatest(a, e))
    seen = F.zip_with(spans, reach, lambda s, r: F.struct(s.start.alias("start"), s.kind.alias("kind"), r.alias("reach")))

    def joined(begun: Column, last: Column) -> Column:
        return F.transform(begun, lambda x, k: F.struct(x.start.alias("start"), F.coalesce(F.get(begun, k + 1).reach, last).alias("end"), x.kind.alias("kind")))

    return let(F.array_max(F.transform(spans, lambda s: s.end)), lambda last: let(F.filter(seen, lambda x: x.start >= x.reach), lambda begun: joined(begun, last)))


def redact(text: Column, spans: Column) -> Column:
    """The text with every stretch of personal data replaced by its kind in angle brackets.

    Overlapping spans make one stretch under the name of the first. Null stays null. The text
    is cut in blocks of CUT code points; each block looks at the stretches in it alone.
    """

    def block(part: Column, number: Column, all_of: Column) -> Column:
        begin = number * CUT
        inside = F.transform(
            F.filter(all_of, lambda s: (s.end > begin) & (s.start < begin + CUT)),
            lambda s: F.struct((s.start - begin).alias("start"), (s.end - begin).alias("end"), s.kind.alias("kind")),
        )

        def pieces(found: Column) -> Column:
            def piece(s: Column, k: Column) -> Column:
                done = F.coalesce(F.get(found, k - 1).end, F.lit(0))
                tag = F.when(s.start >= 0, F.concat(F.lit("<"), s.kind, F.lit(">"))).otherwise("")
                return F.concat(F.substr(part, done + 1, F.greatest(s.start - done, F.lit(0))), tag)

            rest = F.coalesce(F.get(found, F.size(found) - 1).end, F.lit(0))
            return F.concat(F.array_join(F.transform(found, piece), ""), F.substr(part, rest + 1, F.lit(CUT)))

        return F.when(F.size(inside) > 0, let(inside, pieces)).otherwise(part)

    parts = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))
    cut = let(stretches(spans), lambda found: F.array_join(F.transform(parts, lambda p, k: block(p, k, found)), ""))
    return F.when(F.size(spans) > 0, cut).otherwise(text)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and list of personal spans of all documents."""
    got = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"), "pii")

    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    base = F.filter("pii", lambda s: s.kind_order < len(BASE))
    return got.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("pii")).alias("spans"), F.size("pii").cast("long").alias("n_spans"))
