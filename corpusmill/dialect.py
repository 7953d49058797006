"""One rule, two engines: SQL expressions for Spark and for the DuckDB oracle.

Scalar rules are functions of (dialect, SQL expression) that give SQL text. Spark
runs them through ``F.expr`` inside whole-stage code generation; the same rule
rendered for DuckDB is the oracle that holds the Spark result. A rule of several
steps is a :class:`Steps` chain, whose later expressions name earlier columns.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CLASSES = re.compile(r"\\[swdbSWDB]")
#: White space beyond ASCII, for engines whose \s is ASCII.
WIDE_SPACE = r"\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
#: The same and ASCII's, as characters: what \s is with the flag U.
BLANKS = "\t\n\x0b\f\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


class Spark:
    name = "spark"

    def lit(self, text: str | None) -> str:
        if text is None:
            return "CAST(NULL AS STRING)"
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    def rx(self, pattern: str, flags: str = "") -> str:
        flags += "U" if _CLASSES.search(pattern) else ""
        return self.lit(f"(?{flags}){pattern}" if flags else pattern)

    def has(self, x: str, pattern: str, flags: str = "") -> str:
        return f"({x} RLIKE {self.rx(pattern, flags)})"

    def sub(self, x: str, pattern: str, to: str = "", flags: str = "") -> str:
        return f"regexp_replace({x}, {self.rx(pattern, flags)}, {self.lit(to.replace(chr(92), '$'))})"

    def count(self, x: str, pattern: str, flags: str = "") -> str:
        return f"CAST(regexp_count({x}, {self.rx(pattern, flags)}) AS BIGINT)"

    def extract(self, x: str, pattern: str, group: int = 0, flags: str = "") -> str:
        return f"regexp_extract({x}, {self.rx(pattern, flags)}, {group})"

    def extract_all(self, x: str, pattern: str, group: int = 0, flags: str = "") -> str:
        return f"regexp_extract_all({x}, {self.rx(pattern, flags)}, {group})"

    def strip(self, x: str) -> str:
        return f"trim(BOTH {self.lit(BLANKS)} FROM {x})"

    def size(self, x: str) -> str:
        return f"CAST(size({x}) AS BIGINT)"

    def distinct(self, x: str) -> str:
        return f"array_distinct({x})"

    def join(self, x: str, by: str) -> str:
        return f"array_join({x}, {self.lit(by)})"

    def transform(self, x: str, var: str, body: str) -> str:
        return f"transform({x}, {var} -> {body})"

    def filter(self, x: str, var: str, body: str) -> str:
        return f"filter({x}, {var} -> {body})"

    def split(self, x: str, by: str) -> str:
        return f"split({x}, {self.rx(by)}, -1)"

    def common(self, x: str, y: str) -> str:
        return f"array_intersect({x}, {y})"

    def element(self, x: str, i: str) -> str:
        return f"try_element_at({x}, CAST({i} AS INT))"

    def sequence(self, a: str, b: str) -> str:
        return f"CASE WHEN {b} >= {a} THEN sequence(CAST({a} AS BIGINT), CAST({b} AS BIGINT)) ELSE CAST(array() AS ARRAY<BIGINT>) END"

    def sha256(self, x: str) -> str:
        return f"sha2({x}, 256)"

    array = "array({})".format

    def words(self, items: Sequence[str]) -> str:
        return "array(" + ", ".join(map(self.lit, items)) + ")"


class Duck(Spark):
    name = "duckdb"

    def lit(self, text: str | None) -> str:
        return "CAST(NULL AS VARCHAR)" if text is None else "'" + text.replace("'", "''") + "'"

    def rx(self, pattern: str, flags: str = "") -> str:
        flags = "".join(c for c in flags if c in "imsx")
        return self.lit(f"(?{flags}){pattern}" if flags else pattern)

    def has(self, x: str, pattern: str, flags: str = "") -> str:
        return f"regexp_matches({x}, {self.rx(pattern, flags)})"

    def sub(self, x: str, pattern: str, to: str = "", flags: str = "") -> str:
        return f"regexp_replace({x}, {self.rx(pattern, flags)}, {self.lit(to)}, 'g')"

    def count(self, x: str, pattern: str, flags: str = "") -> str:
        return f"CAST(len(regexp_extract_all({x}, {self.rx(pattern, flags)})) AS BIGINT)"

    def strip(self, x: str) -> str:
        return f"regexp_replace({x}, {self.lit(f'^[{WIDE_SPACE}]+|[{WIDE_SPACE}]+$')}, '', 'g')"

    def size(self, x: str) -> str:
        return f"CAST(len({x}) AS BIGINT)"

    def distinct(self, x: str) -> str:
        return f"list_distinct({x})"

    def join(self, x: str, by: str) -> str:
        return f"array_to_string({x}, {self.lit(by)})"

    def transform(self, x: str, var: str, body: str) -> str:
        return f"list_transform({x}, lambda {var}: {body})"

    def filter(self, x: str, var: str, body: str) -> str:
        return f"list_filter({x}, lambda {var}: {body})"

    def split(self, x: str, by: str) -> str:
        return f"regexp_split_to_array({x}, {self.rx(by)})"

    def common(self, x: str, y: str) -> str:
        return f"list_intersect({x}, {y})"

    def element(self, x: str, i: str) -> str:
        return f"({x})[CAST({i} AS BIGINT)]"

    def sequence(self, a: str, b: str) -> str:
        return f"range(CAST({a} AS BIGINT), CAST({b} AS BIGINT) + 1)"

    def sha256(self, x: str) -> str:
        return f"sha256({x})"

    array = "[{}]".format

    def words(self, items: Sequence[str]) -> str:
        return "[" + ", ".join(map(self.lit, items)) + "]"


SPARK, DUCK = Spark(), Duck()
Rule = Callable[..., str]


def any_of(d: Spark, x: str, words: Sequence[str]) -> str:
    """Whether the text holds one of the words."""
    return "(" + " OR ".join(f"contains({x}, {d.lit(w)})" for w in words) + ")"


def ends(d: Spark, x: str, words: Sequence[str]) -> str:
    return "(" + " OR ".join(f"{'endswith' if d.name == 'spark' else 'suffix'}({x}, {d.lit(w)})" for w in words) + ")"


def starts(d: Spark, x: str, words: Sequence[str]) -> str:
    return "(" + " OR ".join(f"{'startswith' if d.name == 'spark' else 'starts_with'}({x}, {d.lit(w)})" for w in words) + ")"


def unless(d: Spark, x: str, words: Sequence[str], value: str, none: str) -> str:
    """``value``, which is ``none`` for texts without any of the words; Spark doesn't work it out for those."""
    return f"CASE WHEN NOT {any_of(d, x, words)} THEN {none} ELSE {value} END" if d.name == "spark" else value


def ladder(rungs: Sequence[tuple[str, str]], default: str) -> str:
    """The first rung whose condition holds."""
    return "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v in rungs) + f" ELSE {default} END"


def column(rule: Rule, *cols: str, **options) -> Column:
    """A rule as a Spark column of the named columns."""
    return F.expr(rule(SPARK, *cols, **options))


class Steps:
    """Columns that build on one another, for both engines."""

    def __init__(self, *steps: tuple[str, Rule]):
        self.steps = steps

    def then(self, *steps: tuple[str, Rule]) -> "Steps":
        return Steps(*self.steps, *steps)

    def on(self, df: DataFrame) -> DataFrame:
        for name, rule in self.steps:
            df = df.withColumn(name, F.expr(rule(SPARK)))
        return df

    def sql(self, source: str) -> str:
        out = f"({source})"
        seen: set[str] = set()
        for name, rule in self.steps:
            made = f"{rule(DUCK)} AS {name}"
            out = f"(SELECT * REPLACE ({made}) FROM {out})" if name in seen else f"(SELECT *, {made} FROM {out})"
            seen.add(name)
        return f"SELECT * FROM {out}"


def values(spark, columns: str, rows: Sequence[tuple]) -> DataFrame:
    """An inline relation; ``columns`` is a Spark schema string."""
    return spark.createDataFrame(list(rows), columns)


def values_sql(columns: str, rows: Sequence[tuple]) -> str:
    """The same relation for DuckDB."""
    kinds = [c.strip().rsplit(" ", 1) for c in columns.split(",")]
    sql_kind = {"string": "VARCHAR", "long": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}

    def cell(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return DUCK.lit(v)
        return str(v).lower() if isinstance(v, bool) else repr(v)

    body = ", ".join("(" + ", ".join(cell(v) for v in r) + ")" for r in rows)
    cast = ", ".join(f"CAST({n} AS {sql_kind[k]}) AS {n}" for n, k in kinds)
    return f"SELECT {cast} FROM (VALUES {body}) AS v({', '.join(n for n, _ in kinds)})"
