"""Personal data: patterns propose, checksums confirm, context words adjust the score.

Everything is a column expression on one row: no shuffle, no Python.  The engine has no function
for the places of all matches, so a text is both split by a pattern and searched for it: the lengths of
the pieces and of the matches, summed up in turn, are the places.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metrivane.llm.common import ascii_lower, table

CONTEXT = 40  # code points before and after a span that are searched for context words

# A run of the leading class can start a match at its first character or just behind the last match
# only, so the patterns look there only; together with possessive repeats every search is linear.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
NATIONAL_ID = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
PART = r"^0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])$"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` pass the Luhn check."""
    each = F.split(F.reverse(digits(value)), "")

    def weigh(char: Column, i: Column) -> Column:
        doubled = char.try_cast("int") * (1 + i % 2)
        return F.coalesce(F.when(doubled > 9, doubled - 9).otherwise(doubled), F.lit(0))

    return F.aggregate(F.transform(each, weigh), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether an account number passes the mod-97 check."""
    plain = F.regexp_replace(value, r"\x20", "")
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))

    def feed(rest: Column, char: Column) -> Column:
        digit = char.try_cast("int")
        return F.when(char == "", rest).when(digit.isNotNull(), (rest * 10 + digit) % 97).otherwise((rest * 100 + F.ascii(char) - 55) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), feed) == 1


def between(low: int, high: int):
    return lambda value: F.length(digits(value)).between(low, high)


@dataclass(frozen=True)
class Kind:
    """A kind of personal data.

    hint: a plain string without which a text holds none.  base: a span that passes ``valid`` counts
    whatever its score; others count from THRESHOLD on.  prior: the score without context.
    """

    name: str
    pattern: str
    valid: object
    hint: str | None = None
    base: bool = True
    prior: float = 0.9
    near: tuple[str, ...] = ()
    far: tuple[str, ...] = field(default=("example", "sample", "version", "isbn"))


THRESHOLD = 0.6
KINDS = (
    Kind("email", EMAIL, lambda v: F.lit(True), "@", near=("mail", "contact", "write")),
    Kind("ip", IP, lambda v: F.forall(F.split(v, r"\."), lambda p: p.rlike(PART)), ".", prior=0.7, near=("ip", "address", "server", "host")),
    Kind("card", CARD, lambda v: F.when(between(16, 19)(v), luhn(v)).otherwise(False), near=("card", "visa", "pay", "credit")),
    Kind("phone", PHONE, between(8, 15), "+", prior=0.8, near=("phone", "call", "tel", "mobile")),
    Kind("iban", IBAN, mod97, base=False, prior=0.8, near=("iban", "account", "bank", "transfer")),
    Kind("national_id", NATIONAL_ID, lambda v: ~v.rlike("^(000|666|9)|-00-|-0000$"), "-", base=False, prior=0.4, near=("ssn", "social", "security", "national")),
)


def confirmed(text: Column, kind: Kind) -> Column:
    """array<struct<start, end>> of the leftmost non-overlapping matches that are valid, in code points."""
    values = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    pieces = F.split(text, kind.pattern, -1)
    joined = F.arrays_zip(values.alias("value"), F.transform(pieces, F.length).alias("gap"))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("found"))

    def step(state: Column, x: Column) -> Column:
        begin = state["at"] + F.coalesce(x["gap"], F.lit(0))
        end = begin + F.coalesce(F.length(x["value"]), F.lit(0))
        one = F.array(F.struct(begin.alias("start"), end.alias("end")))
        good = x["value"].isNotNull() & kind.valid(x["value"])
        return F.struct(end.alias("at"), F.when(good, F.concat(state["found"], one)).otherwise(state["found"]).alias("found"))

    return F.aggregate(joined, start, step, lambda s: s["found"])


def scored(text: Column, kind: Kind) -> Column:
    """array<struct<kind, start, end, score>> of the confirmed spans of one kind, in order."""

    def words(places_text: Column, which: tuple[str, ...]) -> Column:
        hits = F.lit(False)
        for w in which:
            hits = hits | F.contains(places_text, F.lit(w))
        return hits

    def score(s: Column) -> Column:
        begin = F.greatest(s["start"] - CONTEXT, F.lit(0))
        around = ascii_lower(
            F.concat(F.substring(text, begin + 1, s["start"] - begin), F.lit(" "), F.substring(text, s["end"] + 1, F.lit(CONTEXT)))
        )
        value = F.lit(kind.prior) + F.when(words(around, kind.near), 0.3).otherwise(0.0) - F.when(words(around, kind.far), 0.2).otherwise(0.0)
        return F.struct(F.lit(kind.name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.least(F.lit(1.0), value).alias("score"))

    spans = F.transform(confirmed(text, kind), score)
    if not kind.base:
        spans = F.filter(spans, lambda s: s["score"] >= THRESHOLD)
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int,score:double>>)")
    return spans if kind.hint is None else F.when(F.contains(text, F.lit(kind.hint)), spans).otherwise(none)


def find(docs: DataFrame) -> DataFrame:
    """``docs`` with ``pii``: array<struct<kind, start, end, score>>, by kind as listed, then start.

    Ends are exclusive, places count code points.  A null or empty text has no spans.  All other
    columns, nulls and repeated rows pass unchanged; a column named pii is replaced.
    """
    text = F.coalesce(docs["text"], F.lit(""))
    return docs.withColumn("pii", F.concat(*[scored(text, k) for k in KINDS]))


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of the text replaced by ``<KIND>``; overlapping spans become one mark,
    named after the one that starts first.  A null text stays null; n_chars, if there, follows the text.
    """
    found = find(docs.withColumnRenamed("pii", "__pii")) if "pii" in docs.columns else find(docs)
    by_start = F.array_sort(F.transform("pii", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("last"), s["kind"].alias("kind"))))
    begin = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<string>)").alias("out"))

    def step(state: Column, s: Column) -> Column:
        piece = F.array(F.substring(F.col("text"), state["at"] + 1, s["start"] - state["at"]), F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">")))
        inside = s["start"] < state["at"]
        return F.struct(
            F.greatest(state["at"], -s["last"]).alias("at"), F.when(inside, state["out"]).otherwise(F.concat(state["out"], piece)).alias("out")
        )

    masked = F.aggregate(
        by_start, begin, step, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(F.col("text"), s["at"] + 1, F.lit(2147483647)))
    )
    new = found.withColumn("text", F.when(F.size("pii") > 0, masked).otherwise(F.col("text"))).drop("pii")
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return new.withColumnRenamed("__pii", "pii").select(*[f"`{c}`" for c in docs.columns])


def digest_columns(found: DataFrame) -> DataFrame:
    base = [k.name for k in KINDS if k.base]

    def spelled(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(name: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    return found.select(
        "doc_id", *[count(n) for n in base],
        F.sha2(spelled(F.filter("pii", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        spelled(F.col("pii")).alias("spans"),
    )


def op10_pii(spark, sf_dir: str) -> DataFrame:
    return digest_columns(find(table(spark, sf_dir, "documents").select("doc_id", "text")))
