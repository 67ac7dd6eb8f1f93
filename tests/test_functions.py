import random
import zlib

import pytest
from pyspark.sql import functions as F

from reshard.functions import events, hashing, positions, values


def evaluate(spark, value, kind, *columns):
    return spark.createDataFrame([(value,)], f"x {kind}").select(*columns).first()


def signed(number):
    return number - 2**64 if number >= 2**63 else number


@pytest.mark.parametrize(
    "text, expected",
    [
        ("0", 0),
        ("007", 7),
        ("0000000000000000000000000000012", 12),
        ("6755399444017774", 6755399444017774),
        ("9223372036854775807", 2**63 - 1),
        ("9223372036854775808", -(2**63)),
        ("18446744073709551615", -1),
        ("18446744073709551616", None),
        ("99999999999999999999", None),
        ("123456789012345678901234567890", None),
        ("", None),
        ("+5", None),
        ("-5", None),
        (" 5 ", None),
        ("5\n", None),
        ("1_000", None),
        ("abc", None),
        ("٣", None),
        ("naïve", None),
    ],
)
def test_hash_string(spark, text, expected):
    found = evaluate(spark, text, "string", hashing.hash_string(F.col("x")))[0]
    assert found == (zlib.crc32(text.encode()) if expected is None else expected)


def test_hash_string_of_null_is_null(spark):
    assert evaluate(spark, None, "string", hashing.hash_string(F.col("x")))[0] is None


def test_hash_bytes_is_always_a_checksum(spark):
    assert evaluate(spark, b"123", "binary", hashing.hash_bytes(F.col("x")))[0] == zlib.crc32(b"123")
    assert zlib.crc32(b"abc") == 891568578


@pytest.mark.parametrize("key, table", [(6755399444017774, 244), (6755399441094662, 242)])
def test_known_keys(spark, key, table):
    row = evaluate(
        spark, key, "bigint", hashing.shard_index(F.col("x"), 32), hashing.shard_index(F.col("x"), 32, 10),
        hashing.shard_index(F.col("x"), 32, 1), hashing.database_alias(F.lit(table), 10),
    )
    assert tuple(row) == (24, table, 24, "shard24")


@pytest.mark.parametrize("key", [0, 1, 2**48, 2**62 + 12345, 2**63 - 1, 2**63, 2**64 - 1, 2**64 - 2**50])
@pytest.mark.parametrize("shards, location", [(32, 1), (32, 2), (7, 10), (1, 3)])
def test_index_is_unsigned(spark, key, shards, location):
    slot = (key >> 48) & 4095
    expected = slot % shards if location < 2 else (slot % shards) * location + key % location
    assert evaluate(spark, signed(key), "bigint", hashing.shard_index(F.col("x"), shards, location))[0] == expected


def test_hash_by_type(spark):
    assert evaluate(spark, 5, "int", hashing.hash_key(F.col("x"), "int"))[0] == 5
    unsigned = spark.sql("SELECT CAST('18446744073709551615' AS decimal(20,0)) AS x")
    assert unsigned.select(hashing.hash_key(F.col("x"), "decimal(20,0)")).first()[0] == -1
    with pytest.raises(ValueError):
        hashing.hash_key(F.col("x"), "double")


@pytest.mark.parametrize(
    "text, kind",
    [
        ("insert into t", "Insert"),
        ("UPDATE t", "Update"),
        ("Delete", "Delete"),
        ("\tinsert into t", "Insert"),
        (" insert into t", "NoDML"),
        ("insert\tinto t", "NoDML"),
        ("REPLACE INTO t", "NoDML"),
        ("WriteRowsEventV2", "Insert"),
        ("UpdateRowsEventV1", "Update"),
        ("DeleteRowsEventV0", "Delete"),
        ("writerowsEventV2", "NoDML"),
        ("", "NoDML"),
    ],
)
def test_classify(spark, text, kind):
    assert evaluate(spark, text, "string", events.classify_dml(F.col("x")))[0] == kind


@pytest.mark.parametrize(
    "name, pattern, match",
    [
        ("Shard_0", "shard_*", True),
        ("shardX0", "shard_*", False),
        ("SHARD_", "Shard_*", True),
        ("comment", "Comment", True),
        ("comments", "comment", False),
        ("anything", "*", True),
        ("a%b", "a%*", True),
        ("axb", "a%*", False),
    ],
)
def test_name_patterns(spark, name, pattern, match):
    assert evaluate(spark, name, "string", events.name_matches(F.col("x"), pattern))[0] is match


def test_empty_pattern_is_refused():
    with pytest.raises(ValueError):
        events.name_matches(F.lit("x"), "")


def test_file_names(spark):
    cases = {
        "mysql-bin.00017": ("mysql-bin.00018", "mysql-bin.00016", 17, 5),
        "mysql-bin.00099": ("mysql-bin.00100", "mysql-bin.00098", 99, 5),
        "mysql.00.prod.com.00099": ("mysql.00.prod.com.00100", "mysql.00.prod.com.00098", 99, 5),
        "mysql.00.prod.com.00100": ("mysql.00.prod.com.00101", "mysql.00.prod.com.00099", 100, 5),
        "mysql.00.prod.com.00000": ("mysql.00.prod.com.00001", None, 0, 5),
        "mysql-bin.99999": ("mysql-bin.100000", "mysql-bin.99998", 99999, 5),
        "mysql-bin": (None, None, 0, 0),
        "000789": ("000790", "000788", 789, 6),
    }
    x = F.col("x")
    for name, expected in cases.items():
        row = evaluate(
            spark, name, "string", positions.next_file(x), positions.previous_file(x), positions.file_number(x),
            positions.file_number_width(x),
        )
        assert tuple(row) == expected, name
    a, b = F.lit("mysql-bin.00017"), F.lit("mysql-bin.00022")
    row = evaluate(spark, 1, "int", positions.file_distance(a, a), positions.file_distance(a, b), positions.file_distance(b, a))
    assert tuple(row) == (0, 5, -5)


def test_position_order(spark):
    ordered = [("mysql-bin.00017", 104), ("mysql-bin.00017", 5000), ("mysql-bin.00112", 104)]
    for i, (f1, p1) in enumerate(ordered):
        for j, (f2, p2) in enumerate(ordered):
            one, two = positions.position(F.lit(f1), F.lit(p1)), positions.position(F.lit(f2), F.lit(p2))
            row = evaluate(spark, 1, "int", one < two, one <= two, one == two)
            assert tuple(row) == (i < j, i <= j, i == j)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("mysql-bin.024709:19464691", ("mysql-bin.024709", 19464691)),
        ("a:b:5", None),
        ("a:5:6", None),
        ("mysql-bin.024709", None),
        ("mysql-bin.024709:", None),
        ("mysql-bin.024709:x", None),
        ("mysql-bin.024709: 5", None),
        ("mysql-bin.024709:99999999999999999999", None),
        (":7", ("", 7)),
    ],
)
def test_parse_position(spark, text, expected):
    found = evaluate(spark, text, "string", positions.parse_position(F.col("x")))[0]
    assert (None if found is None else tuple(found)) == expected


def test_show_and_detached(spark):
    row = evaluate(
        spark, "//mysql-bin.01234:567890", "string", positions.is_detached(F.col("x")),
        positions.detached_position(F.col("x")), positions.show_position(F.lit("f"), F.lit(4)),
        positions.is_detached(F.lit("mysql-bin.01234")),
    )
    assert (row[0], tuple(row[1]), row[2], row[3]) == (True, ("mysql-bin.01234", 567890), "f:4", False)


def test_unsigned(spark):
    for bits, kind in ((8, "tinyint"), (16, "smallint"), (24, "int"), (32, "int")):
        for value in (-(2 ** (bits - 1)), -1, 0, 2 ** (bits - 1) - 1):
            assert evaluate(spark, value, kind, values.unsigned_value(F.col("x"), bits))[0] == value % 2**bits
    for value in (-(2**63), -1, 0, 2**63 - 1):
        assert evaluate(spark, value, "bigint", values.unsigned_text(F.col("x")))[0] == str(value % 2**64)


def test_latin1_all_bytes(spark):
    data = bytes(range(256))
    expected = "".join(
        chr(b) if b in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else bytes([b]).decode("cp1252") for b in range(256)
    )
    assert evaluate(spark, data, "binary", values.latin1_text(F.col("x")))[0] == expected


def test_image_text(spark):
    assert evaluate(spark, ["1", None, "x,y"], "array<string>", values.image_text(F.col("x")))[0] == "1,<nil>,x,y"
    assert evaluate(spark, [b"ab", b"1"], "array<binary>", values.image_text(F.col("x")))[0] == "ab,1"


def test_hash_string_against_a_model(spark):
    rnd = random.Random(7)
    texts = ["".join(rnd.choice("0123456789") for _ in range(rnd.randrange(1, 26))) for _ in range(3000)]
    texts += ["".join(rnd.choice("0189 +-a\n_é") for _ in range(rnd.randrange(0, 6))) for _ in range(3000)]
    texts += [str(2**64 + d) for d in range(-50, 50)] + ["0" * 30 + str(2**63 + d) for d in range(-50, 50)]

    def model(text):
        if text and all(c in "0123456789" for c in text) and int(text) < 2**64:
            return signed(int(text))
        return zlib.crc32(text.encode())

    frame = spark.createDataFrame([(t,) for t in texts], "x string")
    hashed = hashing.hash_string(F.col("x")).alias("h")
    index = hashing.shard_index(F.col("h"), 7, 6).alias("i")
    for text, found, place in frame.select("x", hashed).select("x", "h", index).collect():
        assert found == model(text), text
        unsigned = found % 2**64
        assert place == ((unsigned >> 48) & 4095) % 7 * 6 + unsigned % 6, text
