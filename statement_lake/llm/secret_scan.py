"""Secrets in texts: fixed patterns, and a battery of randomness tests for other strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statement_lake.llm.spans import apart, joined, kept, let, masked, merged, spans
from statement_lake.session import settle

# Fixed patterns of the three base kinds.
ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_LIKELY = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"[0-9a-f]{16,}+"
BASE_KINDS = ("assign", "access", "hex")

#: Strings that are tested: unbroken, of this length at least, with a letter and a digit.
#: A sign of equality ends one and may stand before the next (NAME=value, url parameters).
LEAST = 20
STRING = rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{LEAST},}}+"
#: Encodings that are tried in turn, and their alphabets, in order.
ENCODINGS = (
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"),
    ("lower", "abcdefghijklmnopqrstuvwxyz0123456789"),
    ("alnum", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
#: Length classes begin here; steps of the p-value; share of false finds that is allowed.
CLASSES, STEPS, LEVEL = (20, 28, 40, 64), 20, 0.05
#: The highest step a cut-off may have unless told otherwise: nine of ten random strings
#: stay above it, however many others there are.
HIGHEST = 2
#: A class with fewer strings above the middle step is judged by pooled counts.
ENOUGH = 10
#: Letters that written words have most of; about five of eight letters in European languages.
FREQUENT = "aeinorst"
#: So many independent tests have the battery's least p-value on random strings, as measured
#: (five tests that are correlated; four on hexadecimal digits).
TESTS, HEX_TESTS = 4.2, 3.2


def _kind(char: Column) -> Column:
    """Digits, upper case, lower case, others."""
    return (
        F.when(char.between("0", "9"), 0).when(char.between("A", "Z"), 1).when(char.between("a", "z"), 2).otherwise(3)
    )


def _shares(letters: str) -> list[float]:
    kinds = [0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3 for c in letters]
    return [kinds.count(k) / len(letters) for k in range(4)]


def _changes(letters: str) -> tuple[float, float]:
    """Chance that two neighbouring letters differ in kind, and that two neighbouring pairs both do."""
    shares = _shares(letters)
    return 1 - sum(p * p for p in shares), sum(p * (1 - p) ** 2 for p in shares)


def _normal_above(z: Column) -> Column:
    """Probability that a standard normal exceeds z, by the logistic approximation."""
    return 1 / (1 + F.exp(1.5976 * z + 0.07056 * F.pow(z, F.lit(3.0))))


def _beyond(z: Column) -> Column:
    return 2 * _normal_above(F.abs(z))


def alphabet(text: Column) -> Column:
    """The first encoding whose alphabet has all characters of the text, or null."""
    found = F.lit(None).cast("string")
    for name, letters in reversed(ENCODINGS):
        pattern = "^[" + letters.replace("-", r"\-") + "]+$"
        found = F.when(text.rlike(pattern), F.lit(name)).otherwise(found)
    return found


def randomness(text: Column, encoding: Column) -> Column:
    """p-value of the hypothesis that the text is random in its encoding.

    Five tests: chi-squared of the letter counts against an even alphabet (by the
    Wilson-Hilferty approximation); the number of runs above and below the middle
    of the alphabet; the correlation of neighbouring letters' numbers; the number
    of changes between digits, upper and lower case, which words and identifiers
    have few of; the share of frequent letters among all letters, which words have
    many of (not for hexadecimal digits).  The least of the tests is taken as the
    least of TESTS even ones, so that random strings spread evenly over (0, 1).
    """
    share = len(FREQUENT) / 26
    plain = F.lower(encoding) == "hex"

    def frequent() -> Column:
        seen = F.length(F.regexp_replace(text, f"(?i)[^{FREQUENT}]", "")).cast("double")
        all_letters = F.length(F.regexp_replace(text, "[^A-Za-z]", "")).cast("double")
        z = (seen - all_letters * share) / F.sqrt(all_letters * (share * (1 - share)))
        return F.when(plain, 1.0).otherwise(_normal_above(z))

    letters = F.create_map(*[F.lit(x) for pair in ENCODINGS for x in pair])
    one = F.create_map(*[F.lit(x) for name, known in ENCODINGS for x in (name, _changes(known)[0])])
    both = F.create_map(*[F.lit(x) for name, known in ENCODINGS for x in (name, _changes(known)[1])])

    def changes(kinds: Column) -> Column:
        n = F.size(kinds).cast("double")
        seen = F.size(
            F.filter(F.sequence(F.lit(1), F.size(kinds) - 1), lambda i: F.get(kinds, i) != F.get(kinds, i - 1))
        )
        q = one[encoding]
        spread = F.sqrt((n - 1) * q * (1 - q) + 2 * (n - 2) * (both[encoding] - q * q))
        return _beyond((seen - (n - 1) * q) / spread)

    def tested(chars: Column, values: Column, size: Column) -> Column:
        n = F.size(chars).cast("double")
        squares = F.aggregate(
            F.array_distinct(chars),
            F.lit(0.0),
            lambda a, c: a + F.pow(F.size(F.filter(chars, lambda x: x == c)).cast("double"), F.lit(2.0)),
        )
        chi = squares * size / n - n
        free = size - 1
        even = 2 / (9 * free)
        p_even = _normal_above((F.cbrt(chi / free) - (1 - even)) / F.sqrt(even))

        high = F.transform(values, lambda v: (v * 2 >= size).cast("int"))

        def runs(bits: Column) -> Column:
            above = F.aggregate(bits, F.lit(0), lambda a, b: a + b).cast("double")
            below = n - above
            changes = F.aggregate(
                F.zip_with(
                    F.slice(bits, F.lit(2), F.size(bits)),
                    F.slice(bits, F.lit(1), F.size(bits) - 1),
                    lambda a, b: (a != b).cast("int"),
                ),
                F.lit(0),
                lambda a, b: a + b,
            )
            mean = 2 * above * below / n + 1
            spread = F.sqrt((mean - 1) * (mean - 2) / (n - 1))
            z = (changes + 1 - mean) / spread
            return F.when((above == 0) | (below == 0) | (spread == 0), 0.0).otherwise(_beyond(z))

        total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)

        def serial(mean: Column) -> Column:
            off = F.transform(values, lambda v: v - mean)
            around = F.aggregate(off, F.lit(0.0), lambda a, v: a + v * v)
            pairs = F.aggregate(
                F.zip_with(
                    F.slice(off, F.lit(2), F.size(off)),
                    F.slice(off, F.lit(1), F.size(off) - 1),
                    lambda a, b: a * b,
                ),
                F.lit(0.0),
                lambda a, v: a + v,
            )
            z = (pairs / around + 1 / n) * F.sqrt(n)
            return F.when(around == 0, 0.0).otherwise(_beyond(z))

        kinds = F.transform(chars, _kind)
        least = F.least(p_even, let(high, runs), let(total / n, serial), let(kinds, changes), frequent())
        return 1 - F.pow(1 - F.least(F.lit(1.0), least), F.when(plain, HEX_TESTS).otherwise(TESTS))

    def over(chars: Column) -> Column:
        known = letters[encoding]
        values = F.transform(chars, lambda c: (F.instr(known, c) - 1).cast("double"))
        return let(
            values, lambda v: let(F.length(known).cast("double"), lambda size: tested(chars, v, size))
        )

    return let(F.split(text, ""), over)


def length_class(text: Column) -> Column:
    found = F.lit(0)
    for number, least in enumerate(CLASSES):
        found = F.when(F.length(text) >= least, F.lit(number)).otherwise(found)
    return found


def _step(counts: list[int], level: float, highest: int | None) -> int | None:
    """The lowest step above which at most a share ``level`` of the strings is not random, if one tells.

    Random strings are as many in every step; the steps of the upper half tell how many.
    """
    half = STEPS // 2
    even = sum(counts[half:]) / (STEPS - half)
    for step in range(1, half + 1 if highest is None else min(highest, half) + 1):
        above = sum(counts[step:])
        if above and above - even * (STEPS - step) <= level * above:
            return step
    return None


def cutoffs(
    strings: DataFrame, level: float = LEVEL, highest: int | None = HIGHEST
) -> dict[tuple[str, int], int]:
    """For each (encoding, length class) the lowest step of p from which strings count as random.

    p-values of random strings spread evenly, those of structured ones gather at
    the low end.  The upper half therefore tells how many strings are random, and
    so how many of those above a step are not: the lowest step at which that share
    stays within ``level`` is taken.  A class with fewer than ENOUGH strings in
    that half takes the step of its length over all encodings, or else of all
    classes together, where those have enough.

    Where no step up to ``highest`` keeps the level, ``highest`` is the cut-off:
    no real string goes because of the others, and the share of false finds may
    be larger.  With None the control goes on to the middle step, and a class
    where none keeps the level has no finds.  Each string counts once.  What
    comes to the driver is a count per encoding, class and step.
    """
    steps = (
        strings.groupBy("text")
        .agg(F.first("encoding").alias("encoding"), F.first("class").alias("class"), F.first("p").alias("p"))
        .groupBy("encoding", "class", F.least(F.floor(F.col("p") * STEPS), F.lit(STEPS - 1)).alias("step"))
        .count()
        .collect()
    )
    held: dict[tuple[str | None, int | None], list[int]] = {}
    for row in steps:
        for key in ((row["encoding"], row["class"]), (None, row["class"]), (None, None)):
            held.setdefault(key, [0] * STEPS)[int(row["step"])] += row["count"]
    found = {}
    for encoding, kind in held:
        if encoding is None:
            continue
        pools = [held[key] for key in ((encoding, kind), (None, kind), (None, None))]
        judged = next((c for c in pools if sum(c[STEPS // 2 :]) >= ENOUGH), pools[-1])
        step = _step(judged, level, highest)
        step = highest if step is None else step
        if step is not None:
            found[encoding, kind] = step
    return found


def _scanned(documents: DataFrame, id_column: str, text_column: str, *more: Column) -> DataFrame:
    """(doc_id, a list of spans per base kind, strings to test with their p-value, more...)"""
    rows = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
        *more,
    )
    body = F.col("text")
    value = lambda t: F.length(F.regexp_extract(t, ASSIGN, 1)) >= 12
    whole = lambda t: F.lit(True)

    mixed = lambda m: m["text"].rlike("[0-9]") & m["text"].rlike("[A-Za-z]")

    def tested(m: Column) -> Column:
        return let(
            alphabet(m["text"]),
            lambda encoding: F.struct(
                m["start"].alias("start"),
                (m["start"] + m["size"]).alias("end"),
                m["text"].alias("text"),
                encoding.alias("encoding"),
                length_class(m["text"]).alias("class"),
                randomness(m["text"], encoding).alias("p"),
            ),
        )

    strings = F.transform(F.filter(spans(body, STRING), mixed), tested)
    return rows.select(
        "doc_id",
        kept(spans(body, ASSIGN, ASSIGN_LIKELY), "assign", 0, value).alias("assign"),
        kept(spans(body, ACCESS), "access", 1, whole).alias("access"),
        kept(spans(body, HEX), "hex", 2, whole).alias("hex"),
        F.filter(strings, lambda s: s["encoding"].isNotNull() & s["p"].isNotNull()).alias("strings"),
        *[F.col(n) for n in rows.columns[2:]],
    )


def _judged(scanned: DataFrame, level: float, highest: int | None) -> DataFrame:
    """The scanned rows with base (all base spans) and random (further spans) in place of the strings."""
    lines = cutoffs(scanned.select(F.explode("strings").alias("s")).select("s.*"), level, highest)
    if lines:
        line = F.create_map(
            *[F.lit(x) for (name, kind), step in sorted(lines.items()) for x in (f"{name}/{kind}", step / STEPS)]
        )
        least = lambda s: line[F.concat(s["encoding"], F.lit("/"), s["class"].cast("string"))]
        passing = F.filter("strings", lambda s: F.coalesce(s["p"] >= least(s), F.lit(False)))
    else:
        passing = F.filter("strings", lambda s: F.lit(False))
    random = F.transform(
        passing,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(3).alias("rank"), s["end"].alias("end"), F.lit("random").alias("kind")
        ),
    )
    base = merged([F.col(k) for k in BASE_KINDS])
    return scanned.withColumn("base", base).withColumn("random", apart(random, F.col("base")))


def find_secrets(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    level: float = LEVEL,
    highest: int | None = HIGHEST,
) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random), one row a document row.

    spans: kind:start:end of all spans by start, then kind, comma-joined; offsets
    are code points, ends exclusive.  Base spans always stay; base_sha256 is over
    them alone.  n_random counts the further ones: strings without a base span
    that the battery finds random, as judged over all documents (see cutoffs for
    level and highest).

    Null texts count as empty and have no spans.  Rows with null or equal doc_ids
    have their own rows; a string that repeats counts once in the judgement.
    Other columns are ignored.
    """
    found = _judged(settle(_scanned(documents, id_column, text_column), "secret-spans"), level, highest)
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(merged([F.col("base"), F.col("random")])).alias("spans"),
        F.size("random").cast("long").alias("n_random"),
    )


def mask_secrets(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    size_column: str | None = "n_chars",
    level: float = LEVEL,
    highest: int | None = HIGHEST,
) -> DataFrame:
    """The documents with every secret replaced by its kind in brackets.

    No row goes.  Texts without secrets, null ones too, stay as they are, as do
    all other columns, but for size_column, the length of the text, where it
    exists and the text has changed.
    """
    rows = documents.select(F.struct("*").alias("row"))
    text = F.col(f"row.`{text_column}`")
    apart_rows = rows.select(F.col(f"row.`{id_column}`").alias("id"), text.alias("text"), "row")
    scanned = settle(_scanned(apart_rows, "id", "text", F.col("row")), "secret-rows")
    found = _judged(scanned, level, highest).withColumn(
        "masked", masked(text, merged([F.col("base"), F.col("random")]))
    )
    changed = F.size("base") + F.size("random") > 0
    columns = []
    for name in documents.columns:
        column = F.col(f"row.`{name}`")
        if name == text_column:
            column = F.col("masked")
        elif name == size_column:
            length = F.length("masked").cast(documents.schema[name].dataType)
            column = F.when(changed, length).otherwise(column)
        columns.append(column.alias(name))
    return found.select(*columns)
