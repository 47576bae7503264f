import random

from pyspark.sql import functions as F

from statement_lake.operators import upsert as U
from tests.helpers import as_list, as_set

SCHEMA = "account string, day date, h string, v int"


def rows(spark, *values, schema=SCHEMA):
    text = schema.replace("day date", "day string")
    df = spark.createDataFrame(list(values), text)
    return df.withColumn("day", F.col("day").cast("date")) if "day" in df.columns else df


def values(df, *columns):
    return [row[0] if len(columns) == 1 else row for row in as_list(df, *columns)]


def test_replace_by_hash_keeps_copies_of_the_batch(spark):
    stored = rows(spark, ("a", "2024-01-01", "x", 1), ("a", "2024-01-01", "x", 1), ("a", "2024-01-01", "y", 2))
    batch = rows(spark, ("a", "2024-01-01", "x", 3), ("a", "2024-01-01", "x", 3), ("b", "2024-01-01", "z", 4))
    assert values(U.replace_by_hash(stored, batch, "h"), "v") == [2, 3, 3, 4]


def test_replace_dates_hits_every_account_and_undated_copies(spark):
    stored = rows(
        spark,
        ("a", "2024-01-01", "s1", 1), ("other", "2024-01-02", "s2", 2), ("a", "2024-01-03", "s3", 3),
        ("a", None, "s4", 4), ("a", None, "s5", 5),
    )
    batch = rows(spark, ("a", "2024-01-01", "n1", 6), ("a", "2024-01-02", "n2", 7), ("a", None, "s4", 8))
    assert values(U.replace_dates(stored, batch, "day", "h"), "v") == [3, 5, 6, 7, 8]
    assert values(U.replace_by_hash(stored, batch, "h"), "v") == [1, 2, 3, 5, 6, 7, 8]


def test_replace_by_key_takes_a_blank_account_for_a_missing_one(spark):
    stored = rows(spark, (None, "2024-01-01", "x", 1), ("a", "2024-01-01", "y", 2), ("a", "2024-01-02", "z", 3))
    batch = rows(spark, ("", "2024-01-01", "n", 4), ("a", "2024-01-02", "m", 5))
    assert values(U.replace_by_key(stored, batch, ["account", "day"]), "v") == [2, 4, 5]


def test_greatest_hash_per_key(spark):
    batch = rows(
        spark,
        ("a", "2024-01-01", "aa", 1), ("a", "2024-01-01", "ab", 2), ("a", "2024-01-02", "aa", 3),
        (None, "2024-01-01", "b", 4), ("", "2024-01-01", "a", 5),
    )
    best = U.greatest_hash_per_key(batch, ["account", "day"], "h")
    assert values(best, "account", "v") == [("", 4), ("a", 2), ("a", 3)]


def one_by_one(files, load):
    stored = []
    for name in sorted(files):
        stored = load(stored, files[name])
    return stored


def random_files(seed):
    rng = random.Random(seed)
    days = ["2024-01-01", "2024-01-02", "2024-01-03", None]
    files = {}
    for number in range(5):
        files[f"f{rng.random():.3f}-{number}"] = [
            (rng.choice("ab"), rng.choice(days), rng.choice("pqrst"))
            for _ in range(rng.randint(0, 8))
        ]
    return files


def frame(spark, files):
    # Equal content has equal attributes, so the hash holds the account and the day.
    return rows(
        spark,
        *[
            (account, day, f"{account}{day}{text}", name)
            for name, content in files.items()
            for account, day, text in content
        ],
        schema="account string, day date, h string, file_order string",
    )


def full(content):
    return [(account, day, f"{account}{day}{text}") for account, day, text in content]


def plain(df):
    out = df.select("account", F.col("day").cast("string").alias("day"), "h").collect()
    return sorted((tuple(row) for row in out), key=repr)


def test_bulk_loads_equal_sequential_loads(spark):
    def by_hash(stored, batch):
        new = full(batch)
        return [r for r in stored if r[2] not in {n[2] for n in new}] + new

    def by_dates(stored, batch):
        new = full(batch)
        days = {n[1] for n in new if n[1] is not None}
        hashes = {n[2] for n in new}
        return [r for r in stored if r[1] not in days and r[2] not in hashes] + new

    def by_key(stored, batch):
        best = {}
        for row in sorted(full(batch)):
            best[row[:2]] = row
        return [r for r in stored if r[:2] not in best] + list(best.values())

    for seed in range(3):
        files = random_files(seed)
        loaded = frame(spark, files)
        for bulk, load in (
            (U.last_file_by_hash(loaded, "h"), by_hash),
            (U.last_file_by_date(loaded, "day", "h"), by_dates),
        ):
            assert plain(bulk) == sorted(one_by_one(files, load), key=repr)
        dated = {k: [r for r in v if r[1] is not None] for k, v in files.items()}
        bulk = U.last_file_by_key(frame(spark, dated), ["account", "day"], "h")
        assert plain(bulk) == sorted(one_by_one(dated, by_key), key=repr)


def test_rows_without_a_hash_are_not_lost(spark):
    rows = spark.createDataFrame([("a", 1, None, 5), ("b", 1, None, 6), ("b", 1, "h", 7)], "k string, d int, h string, v int")
    assert as_set(U.greatest_hash_per_key(rows, ["k", "d"], "h"), "k", "h", "v") == {("a", None, 5), ("b", "h", 7)}
