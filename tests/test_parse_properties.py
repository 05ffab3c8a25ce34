"""The parser against a plain-Python model of the JVM semantics it follows:
``String.split(",")`` drops trailing empty fields, ``Integer.parseInt``
takes an optional sign and ASCII digits within the 32-bit range."""

import re

from hypothesis import given, settings, strategies as st

from tagmeans import malformed_lines, parse_postings

FIELDS = ["", "0", "5", "-3", "+7", "007", "2147483647", "2147483648", "-2147483648",
          "-2147483649", "99999999999", " 5", "5 ", "x", "1.5", "+", "-", "C#", "Java",
          "3\u0085", "3\u2028", "4\r", "a\u0085b", "\u2028", "C\r"]


def java_split(line):
    parts = line.split(",")
    while parts and parts[-1] == "":
        parts.pop()
    return parts if line else [""]


def parse_int(s):
    if not re.fullmatch(r"[+-]?[0-9]+", s):
        raise ValueError(s)
    v = int(s)
    if not -2**31 <= v < 2**31:
        raise ValueError(s)
    return v


def model(line):
    """The posting tuple, or None when the line is malformed."""
    try:
        a = java_split(line)
        return (parse_int(a[0]), parse_int(a[1]),
                None if a[2] == "" else parse_int(a[2]),
                None if a[3] == "" else parse_int(a[3]),
                parse_int(a[4]),
                a[5] if len(a) >= 6 else None)
    except (IndexError, ValueError):
        return None


lines_strategy = st.lists(
    st.builds(lambda fs, tail: ",".join(fs) + "," * tail,
              st.lists(st.sampled_from(FIELDS), min_size=0, max_size=8),
              st.integers(0, 2)),
    min_size=1, max_size=40)


@settings(max_examples=25, deadline=None)
@given(lines_strategy)
def test_parser_matches_jvm_model(spark, lines):
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    bad = sorted(r.value for r in malformed_lines(df).collect())
    assert bad == sorted(v for v in lines if model(v) is None)
    got = sorted((tuple(r) for r in parse_postings(df, strict=False).collect()), key=repr)
    assert got == sorted((model(v) for v in lines if model(v) is not None), key=repr)
