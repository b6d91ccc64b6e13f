"""What a predicate refers to: columns, subject, comparison, type."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession

#: Class of the parsed root (negated or not) to the words of a message.
_WORDS = {
    ("GreaterThanOrEqual", False): "is less than", ("LessThanOrEqual", False): "is more than", ("GreaterThan", False): "is not more than",
    ("LessThan", False): "is not less than", ("EqualTo", False): "differs from", ("EqualTo", True): "equals", ("EqualNullSafe", False): "differs from",
}


@dataclass(frozen=True)
class Reading:
    """columns: in written order, once each. words and other: of a comparison whose left side
    is a column."""

    columns: tuple[str, ...] = ()
    words: str | None = None
    other: str | None = None

    @property
    def subject(self) -> str | None:
        return self.columns[0] if self.columns else None


def _kids(e) -> list:
    s = e.children()
    return [s.apply(i) for i in range(s.length())]


def _name(e) -> str | None:
    if e.getClass().getSimpleName() != "UnresolvedAttribute":
        return None
    parts = e.nameParts()
    return ".".join(parts.apply(i) for i in range(parts.length()))


def read_predicate(spark: SparkSession, text: str) -> Reading:
    """Parse a predicate without resolving it. A session without a JVM, or a text that does
    not parse, gives an empty reading."""
    try:
        root = spark._jsparkSession.sessionState().sqlParser().parseExpression(text)
    except Exception:  # Spark Connect, or a parse error that evaluation will report
        return Reading()
    columns: dict[str, None] = {}

    def walk(e) -> None:
        if (name := _name(e)) is not None:
            columns[name] = None
        for k in _kids(e):
            walk(k)

    walk(root)
    negated = root.getClass().getSimpleName() == "Not"
    core = _kids(root)[0] if negated else root
    words = _WORDS.get((core.getClass().getSimpleName(), negated))
    if words and _name(_kids(core)[0]):
        return Reading(tuple(columns), words, _kids(core)[1].sql())
    return Reading(tuple(columns))


def resolve(name: str, df: DataFrame) -> str | None:
    """The column of df that a name means, whatever its case; null if there is none."""
    found = [c for c in df.columns if c.lower() == name.lower()]
    return found[0] if len(found) == 1 else None


def predicate_problem(probe: DataFrame, text: str) -> str | None:
    """Why a text can't be a predicate over these columns, in one line; null if it can."""
    try:
        probe.where(text).schema
    except (AnalysisException, ParseException) as e:
        return str(e).strip().splitlines()[0][:300]
    return None
