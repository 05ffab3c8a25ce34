import os
import tempfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tagmeans import malformed_lines, parse_postings, questions, answers, read_lines


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_question_line(lines_df):
    df = parse_postings(lines_df(["1,27233496,,,0,C#"]))
    assert rows(df) == [(1, 27233496, None, None, 0, "C#")]


def test_answer_line_with_and_without_trailing_comma(lines_df):
    df = parse_postings(lines_df(["2,5494879,,5484340,1", "2,5494879,,5484340,1,"]))
    assert rows(df) == [(2, 5494879, None, 5484340, 1, None)] * 2


def test_trailing_empty_fields_dropped_like_java_split(lines_df):
    df = parse_postings(lines_df(["1,5,,,0,,x", "1,5,,,0,,", "1,5,,,0,C#,"]))
    assert [r.tags for r in df.collect()] == ["", None, "C#"]


def test_extra_fields_ignored_and_quotes_kept(lines_df):
    df = parse_postings(lines_df(["1,5,7,,-3,PHP,extra", '1,6,,,4,"Java"', "+1,-5,,,+2,X"]))
    assert rows(df) == [(1, 5, 7, None, -3, "PHP"), (1, 6, None, None, 4, '"Java"'),
                        (1, -5, None, None, 2, "X")]


BAD = ["", "1,5", "2,5,,x,1", " 1,5,,,0,C#", "99999999999,1,,,0", "1,5,,,0 ", "1,2147483648,,,0",
       "1,5,,,", "a,1,,,0"]


def test_malformed_lines_reasons(lines_df):
    good = ["1,5,,,0,C#", "2,6,,5,3", "1,2147483647,,,-2147483648,X", "1,0000000001,,,0,Y"]
    out = {r.value: r.reason for r in malformed_lines(lines_df(good + BAD)).collect()}
    assert set(out) == set(BAD)
    assert out["99999999999,1,,,0"] == "int_range"
    assert out["1,2147483648,,,0"] == "int_range"
    assert out[" 1,5,,,0,C#"] == "shape"
    assert out[""] == "shape"


@pytest.mark.parametrize("bad", BAD)
def test_strict_parse_fails_on_any_malformed_line(lines_df, bad):
    with pytest.raises(PySparkException):
        parse_postings(lines_df(["1,5,,,0,C#", bad])).collect()


def test_strict_check_survives_column_pruning(lines_df):
    df = parse_postings(lines_df(["1,5,,,0,C#", "1,x,,,0,C#"]))
    with pytest.raises(PySparkException):
        df.select("tags").collect()
    with pytest.raises(PySparkException):
        df.select("accepted_answer").collect()


def test_lenient_parse_drops_malformed(lines_df):
    df = parse_postings(lines_df(["1,5,,,0,C#"] + BAD), strict=False)
    assert rows(df) == [(1, 5, None, None, 0, "C#")]


def test_questions_answers_and_other_types(lines_df):
    p = parse_postings(lines_df(["1,5,,,0,C#", "2,6,,5,3", "3,7,,,1,X"]))
    assert [r.id for r in questions(p).collect()] == [5]
    assert [r.id for r in answers(p).collect()] == [6]


def test_answer_without_parent(lines_df):
    p = parse_postings(lines_df(["1,5,,,0,C#", "2,6,,,3"]))
    with pytest.raises(PySparkException):
        answers(p).collect()
    assert answers(p, strict=False).count() == 1


def test_read_lines_from_text_file(spark):
    d = tempfile.mkdtemp(prefix="tagmeans-lines-")
    path = os.path.join(d, "postings.csv")
    with open(path, "w") as f:
        f.write("1,27233496,,,0,C#\n2,5494879,,27233496,1\n")
    p = parse_postings(read_lines(spark, path))
    assert p.agg(F.count("id")).first()[0] == 2


def test_strict_check_is_not_pruned(lines_df):
    bad = lines_df(["1,5,,,0,C#", "no posting"])
    with pytest.raises(Exception, match="malformed posting line"):
        parse_postings(bad).count()
    with pytest.raises(Exception, match="malformed posting line"):
        questions(parse_postings(bad)).select("id").collect()


def test_line_separators_and_null_lines(lines_df):
    bad = ["2,7,,5,3\u0085", "2,8,,5,4\u2028", "2,9,,5,4\r", None]
    good = ["1,5,,,0,a\u0085b", "1,6,,,0,\u2028", "1,7,,,0,x\r"]
    lines = lines_df(bad + good)
    assert {r.value: r.reason for r in malformed_lines(lines).collect()} == {v: "shape" for v in bad}
    got = {r.id: r.tags for r in parse_postings(lines, strict=False).collect()}
    assert got == {5: "a\u0085b", 6: "\u2028", 7: "x\r"}
    for v in bad:
        with pytest.raises(Exception, match="malformed posting line"):
            parse_postings(lines_df([v])).count()


def test_64_bit_ids(lines_df):
    lines = lines_df(["1,3000000000,,,0,C#", "2,3000000001,,3000000000,4", "1,99999999999999999999,,,0"])
    assert parse_postings(lines, strict=False).count() == 0
    p = parse_postings(lines, strict=False, id_type="bigint")
    assert sorted((r.id, r.parent_id) for r in p.collect()) == [(3000000000, None), (3000000001, 3000000000)]
    assert malformed_lines(lines, "bigint").count() == 1
