"""Personal data in texts: patterns propose, checksums confirm, context words adjust."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statement_lake.llm.spans import apart, joined, kept, let, merged, spans

# Fixed patterns of the four base kinds.  Possessive quantifiers and the look
# behind change no match; they keep the search linear in long runs of one class.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
CARD_LIKELY = r"[0-9](?:[\x20-]?[0-9]){13}"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE_KINDS = ("email", "ip", "card", "phone")

#: Further kinds: pattern, the score that the pattern alone earns.  Of account numbers the
#: pattern is the head alone, so that each begins anew whatever stands before it.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})"
IBAN_LEAST, IBAN_MOST = 15, 34
#: Lengths of account numbers and the countries that have them; all lengths are tried for others.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
LOCAL = r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9-])"
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
SCORES = {"iban": 0.9, "local": 0.4, "social": 0.4}
#: Words near a span that speak for its kind, and for its being something else.
FOR = {
    "iban": r"(?i)iban|account|bank|konto|compte|cuenta",
    "local": r"(?i)phone|call|tel|mobile|fax|contact|anruf|appel|llam",
    "social": r"(?i)ssn|social|security|tax|insurance",
}
AGAINST = r"(?i)order|invoice|version|isbn|serial|part\s*no|article"
#: Characters before and behind a span that are searched for them (for what speaks against it: before it
#: alone, where numbers are named), what they add or take, and what a span needs.
WINDOW, ADDED, TAKEN, NEEDED = 40, 0.3, 0.3, 0.6


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits ends in its Luhn check digit."""

    def value(d: Column, i: Column) -> Column:
        twice = d.cast("int") * 2
        return F.when(i % 2 == 0, d.cast("int")).when(twice > 9, twice - 9).otherwise(twice)

    total = F.aggregate(
        F.transform(F.split(F.reverse(number), ""), value), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))
    )
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number without blanks passes ISO 7064 mod 97-10."""
    turned = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))

    def step(a: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(c.rlike("[0-9]"), a * 10 + c.cast("int")).otherwise(a * 100 + letter) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _accounts(text: Column) -> Column:
    """Account numbers that pass mod 97, as an array of (start, size, text).

    A number has its country's length and ends at a word's end; of several
    lengths the longest that passes.
    """
    known = F.create_map(
        *[F.lit(x) for size, names in IBAN_LENGTHS.items() for name in names.split() for x in (name, size)]
    )
    every = F.sequence(F.lit(IBAN_MOST), F.lit(IBAN_LEAST))

    def whole(m: Column) -> Column:
        after = F.substring(text, (m["start"] + 1).cast("int"), F.lit(2 * IBAN_MOST))
        size = known[F.substring(m["text"], 1, 2)]

        def cut(rest: Column, n: Column) -> Column:
            more = F.concat(
                F.lit(r"^[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){"), (n - 4).cast("string"), F.lit(r"}(?![A-Za-z0-9])")
            )
            return F.call_function("regexp_extract", rest, more, F.lit(0))

        sizes = F.when(size.isNotNull(), F.array(size)).otherwise(every)
        passing = let(
            after,
            lambda rest: F.filter(
                F.transform(sizes, lambda n: cut(rest, n)),
                lambda t: F.when(t == "", F.lit(False)).otherwise(mod97(F.replace(t, F.lit(" "), F.lit("")))),
            ),
        )
        return let(
            F.get(passing, 0),
            lambda t: F.struct(
                m["start"].alias("start"), F.length(t).cast("bigint").alias("size"), t.alias("text")
            ),
        )

    return F.filter(F.transform(spans(text, IBAN), whole), lambda m: m["text"].isNotNull())


def _is_card(text: Column) -> Column:
    return let(
        digits(text), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(F.lit(False))
    )


def _is_ip(text: Column) -> Column:
    part = r"0*(25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
    return text.rlike(rf"^{part}(\.{part}){{3}}$")


def _near(text: Column, matches: Column, kind: str) -> Column:
    """The matches whose score, adjusted by the words around them, is enough."""

    def enough(m: Column) -> Column:
        begin = F.greatest(m["start"] - WINDOW, F.lit(0))
        before = F.substring(text, (begin + 1).cast("int"), (m["start"] - begin).cast("int"))
        behind = F.substring(text, (m["start"] + m["size"] + 1).cast("int"), F.lit(WINDOW))
        score = (
            F.lit(SCORES[kind])
            + F.when(before.rlike(FOR[kind]) | behind.rlike(FOR[kind]), ADDED).otherwise(0.0)
            - F.when(before.rlike(AGAINST), TAKEN).otherwise(0.0)
        )
        return score >= NEEDED

    return F.filter(matches, enough)


def find_personal_data(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_more), one row a document row.

    spans: kind:start:end of all spans by start, then kind, comma-joined; offsets
    are code points, ends exclusive.  Base spans always stay: addresses; ip
    numbers with parts up to 255; card numbers of 14 to 19 digits that pass Luhn;
    phone numbers of 10 to 15 digits.  base_sha256 is over them alone.  n_more
    counts the further ones, which overlap no base span: account numbers that
    pass mod 97, and local phone and social security numbers for which nearby
    words speak.

    Null texts count as empty and have no spans.  Rows with null or equal doc_ids
    have their own rows.  Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    ).select("doc_id", text.alias("text"))
    body = F.col("text")
    length = lambda t: F.length(digits(t))
    base = {
        "email": kept(spans(body, EMAIL, r"@[A-Za-z0-9-]++\."), "email", 0, lambda t: F.lit(True)),
        "ip": kept(spans(body, IP), "ip", 1, _is_ip),
        "card": kept(spans(body, CARD, CARD_LIKELY), "card", 2, _is_card),
        "phone": kept(
            spans(body, PHONE), "phone", 3, lambda t: length(t).between(10, 15)
        ),
    }
    whole = lambda t: F.lit(True)
    more = {
        "iban": kept(_near(body, _accounts(body), "iban"), "iban", 4, whole),
        "local": kept(_near(body, spans(body, LOCAL), "local"), "local", 5, whole),
        "social": kept(_near(body, spans(body, SOCIAL), "social"), "social", 6, whole),
    }
    found = rows.select(
        "doc_id", *[c.alias(k) for k, c in base.items()], F.concat(*more.values()).alias("further")
    )
    listed = found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        merged([F.col(k) for k in BASE_KINDS]).alias("base"),
        "further",
    )
    extra = listed.withColumn("further", apart(F.col("further"), F.col("base")))
    return extra.select(
        "doc_id",
        *[f"n_{k}" for k in BASE_KINDS],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(merged([F.col("base"), F.col("further")])).alias("spans"),
        F.size("further").cast("long").alias("n_more"),
    )
