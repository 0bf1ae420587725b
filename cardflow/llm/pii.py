"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

All of it is native: a pattern's matches come from `regexp_extract_all` and the text between them
from `split`, so a match starts where the lengths before it add up to. Offsets are code points, the
end is exclusive.

Every confirmed match of a base kind (email, ip, card, phone) is a span, whatever its score. The
kinds that the method adds are spans only from `MIN_SCORE` on:

- iban: 15 to 34 letters and digits whose mod-97 remainder is 1;
- ssn: nine digits as 3-2-4, which no checksum covers, so a word near it must name it.

Defined results: a null or empty text has no spans; equal rows have equal results; other columns are
not read; of a very long text every match is found, in work about proportional to its length.
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_SCORE = 0.6
CONTEXT_CHARS = 40
BLOCK = 256
#: Code points of a block of text from which pieces are cut.
CUT = 256


@dataclass(frozen=True)
class Kind:
    """`hint`: text that each match holds, cheaper to look for than the pattern."""

    name: str
    pattern: str
    score: float
    context: str
    base: bool = True
    hint: str | None = None


#: Quantifiers are possessive wherever giving back cannot help, and a match may only start where a
#: maximal run starts (or the last match ended): the same matches, without retries inside a run and
#: without recursion over its length. The card pattern takes just the maximal runs of 13 to 19.
KINDS = (
    Kind(
        "email",
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.9,
        r"(?i)\b(e-?mail|mail|contact|write|correo|courriel)",
        hint="@",
    ),
    Kind(
        "ip",
        r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        0.7,
        r"(?i)\b(ip|host|server|address|login|adresse)",
        hint=".",
    ),
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){12,18}+(?![\x20-]?[0-9])",
        0.8,
        r"(?i)\b(card|visa|master|amex|credit|tarjeta|karte|carte)",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        0.7,
        r"(?i)\b(phone|tel|call|mobile|cell|tel[eé]fono|telefon|fax)",
        hint="+",
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
        0.8,
        r"(?i)\b(iban|account|konto|cuenta|compte|bank)",
        base=False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        0.3,
        r"(?i)\b(ssn|social security|social-security)",
        base=False,
    ),
)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _mod97(match: Column) -> Column:
    """Remainder of the moved and spelled-out number: letters stand for 10 to 35."""
    plain = F.regexp_replace(match, " ", "")
    moved = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), lambda r, c: F.when(c == "", r).otherwise(step(r, c)))


def _confirmed(kind: str, m: Column) -> Column:
    if kind == "ip":
        parts = F.split(m, r"\.")
        small = lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3
        return F.forall(
            parts, lambda p: small(p) & (F.when(small(p), p.cast("decimal(38,0)")).otherwise(F.lit(999)) <= 255)
        )
    if kind == "card":
        return F.length(_digits(m)).between(13, 19) & F.call_function("luhn_check", _digits(m))
    if kind == "phone":
        return F.length(_digits(m)).between(9, 15)
    if kind == "iban":
        return F.length(F.regexp_replace(m, " ", "")).between(15, 34) & (_mod97(m) == 1)
    return F.lit(True)


def _running(lengths: Column, join: Callable[[Column, Column], Column] = operator.add) -> Column:
    """Running totals of an array (or what `join` makes of them): appended inside blocks, so that a long
    array is not copied for each of its entries, then each block is joined to the last of those before
    it."""
    empty = F.array().cast("array<long>")
    last = lambda a: F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0).cast("long"))
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.floor((F.size(lengths) - 1) / BLOCK), F.lit(0)).cast("int")),
        lambda b: F.aggregate(
            F.slice(lengths, b * BLOCK + 1, F.lit(BLOCK)),
            empty,
            lambda acc, x: F.concat(acc, F.array(join(last(acc), x))),
        ),
    )
    return F.aggregate(
        blocks,
        F.struct(empty.alias("done"), F.lit(0).cast("long").alias("base")),
        lambda acc, block: F.struct(
            F.concat(acc["done"], F.transform(block, lambda x: join(x, acc["base"]))).alias("done"),
            join(acc["base"], last(block)).alias("base"),
        ),
        lambda acc: acc["done"],
    )


def find(docs: DataFrame, text: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """`docs` with `spans`: array of (kind, start, end, score, base) by kind as listed, then start."""
    df = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    none = F.array().cast("array<string>")
    matches, gaps = {}, {}
    for k in kinds:
        t = F.col("_text")
        m = F.regexp_extract_all(t, F.lit(k.pattern), F.lit(0))
        matches[f"_m_{k.name}"] = F.when(t.contains(k.hint), m).otherwise(none) if k.hint else m
    df = df.withColumns(matches)
    for k in kinds:
        m = F.col(f"_m_{k.name}")
        gaps[f"_g_{k.name}"] = F.when(F.size(m) > 0, F.split("_text", k.pattern, -1))
    df = df.withColumns(gaps)
    df = df.withColumns(
        {
            f"_l_{k.name}": F.zip_with(
                f"_g_{k.name}",
                F.concat(F.array(F.lit("")), F.col(f"_m_{k.name}")),
                lambda g, m: (F.length(g) + F.length(m)).cast("long"),
            )
            for k in kinds
        }
    )
    df = df.withColumns(
        {f"_p_{k.name}": F.when(F.col(f"_g_{k.name}").isNotNull(), _running(F.col(f"_l_{k.name}"))) for k in kinds}
    )
    return df.withColumn("spans", F.concat(*[_spans(k) for k in kinds])).drop(
        "_text", *[f"_{c}_{k.name}" for k in kinds for c in "mglp"]
    )


def _spans(k: Kind) -> Column:
    m, g, p = (F.col(f"_{c}_{k.name}") for c in "mgp")
    rows = F.zip_with(
        F.arrays_zip(m.alias("m"), F.slice(p, 1, F.size(m)).alias("p")),
        F.arrays_zip(F.slice(g, 1, F.size(m)).alias("a"), F.slice(g, 2, F.size(m)).alias("b")),
        lambda x, y: F.struct(
            F.lit(k.name).alias("kind"),
            x["p"].alias("start"),
            (x["p"] + F.length(x["m"])).alias("end"),
            F.least(
                F.lit(1.0),
                F.lit(k.score)
                + F.when(
                    F.right(y["a"], F.lit(CONTEXT_CHARS)).rlike(k.context)
                    | F.left(y["b"], F.lit(CONTEXT_CHARS)).rlike(k.context),
                    F.lit(0.4),
                ).otherwise(F.lit(0.0)),
            ).alias("score"),
            F.lit(k.base).alias("base"),
            x["m"].alias("match"),
        ),
    )
    sure = F.filter(rows, lambda r: _confirmed(k.name, r["match"]) & (r["base"] | (r["score"] >= MIN_SCORE)))
    kept = F.transform(
        sure, lambda r: F.struct(*[r[c].alias(c) for c in ("kind", "start", "end", "score", "base")])
    )
    return F.when(g.isNotNull(), kept).otherwise(
        F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:double,base:boolean>>")
    )


def joined(spans: Column) -> Column:
    """kind:start:end, by commas."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with each span's text replaced by its kind in angle brackets; of overlapping spans the
    one that starts first (the longer at a tie) gives the name, and all they cover goes."""
    df = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_d"), F.col(text).alias("_t"))
    df = find(df, "_t").withColumn(
        "_o",
        F.sort_array(F.transform("spans", lambda s: F.struct(s["start"], (-s["end"]).alias("e"), s["kind"]))),
    )
    # how far the spans up to each reach; one that starts there or later gives a name
    df = df.withColumn("_r", _running(F.transform("_o", lambda s: -s["e"]), F.greatest))
    at = lambda a, i: F.element_at(a, i)
    df = df.withColumn(
        "_f",
        F.filter(
            F.sequence(F.lit(1), F.greatest(F.size("_o"), F.lit(1))),
            lambda i: (i == 1) | (at(F.col("_o"), i)["start"] >= at(F.col("_r"), F.greatest(i - 1, F.lit(1)))),
        ),
    )
    # a piece is cut from the few blocks it lies in, not counted off from the text's start
    blocks = F.regexp_extract_all("_t", F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0))
    df = df.withColumn("_b", F.when(F.size("spans") > 0, blocks))

    def cut(start: Column, end: Column) -> Column:
        first = F.floor(start / CUT).cast("int")
        blocks = F.slice("_b", first + 1, F.floor((end - 1) / CUT).cast("int") - first + 1)
        return F.when(end <= start, F.lit("")).otherwise(
            F.substr(F.array_join(blocks, ""), (start % CUT + 1).cast("int"), (end - start).cast("int"))
        )

    def piece(i: Column, k: Column) -> Column:
        span = at(F.col("_o"), i)
        before = F.when(i == 1, F.lit(0).cast("long")).otherwise(at(F.col("_r"), F.greatest(i - 1, F.lit(1))))
        return F.concat(cut(before, span["start"]), F.lit("<"), span["kind"], F.lit(">"))

    tail = cut(at(F.col("_r"), F.lit(-1)), F.length("_t").cast("long"))
    clean = F.when(
        F.size("spans") > 0, F.concat(F.array_join(F.transform("_f", piece), ""), tail)
    ).otherwise(F.col("_t"))
    return df.withColumn("_c", clean).select(
        *[F.col("_c").alias(c) if c == text else F.col(f"_d.`{c}`").alias(c) for c in docs.columns]
    )
