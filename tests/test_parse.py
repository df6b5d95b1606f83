from labelsmith import config as C
from labelsmith.functions import valid_key
from labelsmith.operators.parse import parse_submissions, quarantine_counts, quarantine_split

KEY = "ABCDEFGHIJKLMN-OPQRSTUVWX-Y"


def _parse(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "row_index BIGINT, line STRING")
    return {r.row_index: r for r in parse_submissions(df).collect()}


def test_fields_are_typed_and_trimmed(spark):
    rows = _parse(spark, [f"-40\tInChI=made up\t{KEY}", f" 7 \t a b \t {KEY}\r\n", f"　9 \tq\t{KEY}"])
    assert [(r.cid, r.inchi, r.inchikey, r.invalid_reason) for r in rows.values()] == [
        (-40, "InChI=made up", KEY, None), (7, "a b", KEY, None), (9, "q", KEY, None)]


def test_key_shape(spark):
    keys = {KEY: True, KEY.lower(): False, KEY[:-1]: False, KEY + "Z": False, KEY.replace("-", "_"): False,
            "ABCDEFGHIJKLM0-OPQRSTUVWX-Y": False, "\n" + KEY: False, KEY + "\n": False, "": False, "ÀBCDEFGHIJKLMN-OPQRSTUVWX-Y": False}
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "k STRING")
    got = {r.k: r.ok for r in df.select("k", valid_key("k").alias("ok")).collect()}
    assert got == keys | {None: False}


def test_the_first_failing_check_names_the_reason(spark):
    cases = [
        ("no tabs at all", C.MSG_CID_NOT_INTEGER), ("", C.MSG_CID_NOT_INTEGER), ("0x1f\ta\t" + KEY, C.MSG_CID_NOT_INTEGER),
        ("3e2\ta\t" + KEY, C.MSG_CID_NOT_INTEGER), ("9223372036854775808\ta\t" + KEY, C.MSG_CID_NOT_INTEGER), ("a\t\t", C.MSG_CID_NOT_INTEGER),
        ("31", C.MSG_MISSING_INCHI), ("31\r", C.MSG_MISSING_INCHI), ("31\tsome", C.MSG_MISSING_INCHIKEY), ("31\t", C.MSG_MISSING_INCHIKEY),
        ("31\t\t" + KEY, C.MSG_EMPTY_FIELD), ("31\tsome\t ", C.MSG_EMPTY_FIELD), ("31\t\tshort", C.MSG_EMPTY_FIELD),
        ("31\tsome\tshort", C.MSG_BAD_KEY), (f"31\tsome\t{KEY}\tmore", C.MSG_BAD_KEY), (f"+31\tsome\t{KEY}", None), ("9223372036854775807\ta\t" + KEY, None)]
    rows = _parse(spark, [line for line, _ in cases])
    assert [rows[i].invalid_reason for i in range(len(cases))] == [reason for _, reason in cases]


def test_quarantine_sides_add_up(spark):
    lines = [f"{i}\ta\t{KEY}" if i % 3 else f"{i}\ta" for i in range(10)]
    parsed = parse_submissions(spark.createDataFrame(list(enumerate(lines)), "row_index BIGINT, line STRING"))
    assert {r.split: r.rows for r in quarantine_counts(parsed).collect()} == {"valid": 6, "invalid": 4}
    valid, invalid = quarantine_split(parsed)
    assert (valid.count(), invalid.count()) == (6, 4)
