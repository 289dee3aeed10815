"""Parsers as SQL table functions: ``SELECT t.id, p.* FROM t, LATERAL parse_tasks(t.text) AS p``.

``register`` makes them temporary functions of a session.  They are SQL functions over built-in ones, so
no Python worker is started, and Spark plans them as part of the query that calls them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .functions.text import SPACE
from .operators import parsers

ENDS = rf"(?U)\A{SPACE}+|{SPACE}+\z"

def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _strip(x: str) -> str:
    """As ``functions.text.strip``."""
    return f"regexp_replace({x}, {_quoted(ENDS)}, '')"


def _matches(pattern: str, names: list[str]) -> str:
    """An inline view (pos, and a column for each group) of a pattern's matches in ``text``."""
    groups = [f"regexp_extract_all(text, {_quoted(pattern)}, {i + 1})" for i in range(len(names))]
    zipped = f"arrays_zip({', '.join(groups)})" if len(names) > 1 else groups[0]
    fields = ", ".join(f"m['{i}'] AS {n}" for i, n in enumerate(names)) if len(names) > 1 else f"m AS {names[0]}"
    return f"(SELECT pos, {fields} FROM (SELECT posexplode({zipped}) AS (pos, m)))"


def functions() -> dict[str, tuple[str, str]]:
    """Name to (columns of the result, body)."""
    pair = lambda a, b: rf"(?sd){a}:(.*?){b}:(.*?)(?={a}|$)"
    asked = lambda a, b: ("pos INT, instruction STRING, response STRING", f"SELECT pos, {_strip('i')}, {_strip('r')} FROM {_matches(pair(a, b), ['i', 'r'])} WHERE {_strip('i')} <> ''")
    tasks = lambda pattern: ("pos INT, instruction STRING", f"SELECT pos, i FROM {_matches(pattern, ['i'])} WHERE {_strip('i')} <> ''")
    return {
        "parse_tasks": tasks(parsers.TASKS),
        "parse_tasks_strict": tasks(parsers.TASKS_STRICT),
        "parse_qa": asked("QUESTION", "ANSWER"),
        "parse_prompts": asked("PROMPT", "ANSWER"),
        "parse_descriptions": asked("DESCRIPTION", "GUIDE"),
        "parse_questions": ("pos INT, question STRING", f"SELECT pos, {_strip('q')} FROM {_matches(parsers.QUESTIONS, ['q'])} WHERE {_strip('q')} <> ''"),
        "parse_awareness": (
            "pos INT, variant INT, system STRING, instruction STRING, response STRING",
            f"SELECT pos, v, CASE WHEN v = 1 THEN concat('A chat. ', {_strip('c')}) END, {_strip('q')}, CASE WHEN v = 1 THEN {_strip('x')} ELSE {_strip('a')} END "
            f"FROM (SELECT *, explode(array(0, 1)) AS v FROM {_matches(parsers.AWARENESS, ['q', 'c', 'a', 'x'])}) WHERE {_strip('q')} <> ''",
        ),
        "parse_experience": (
            "setting STRING, experience STRING",
            f"SELECT {_strip('s')}, {_strip('e')} FROM (SELECT regexp_extract(text, {_quoted(parsers.EXPERIENCE)}, 1) AS s, regexp_extract(text, {_quoted(parsers.EXPERIENCE)}, 2) AS e, text RLIKE {_quoted(parsers.EXPERIENCE)} AS ok) WHERE ok",
        ),
    }


def register(spark: SparkSession) -> list[str]:
    """Makes the table functions known to the session; a null text has no rows. Returns their names."""
    made = functions()
    for name, (columns, body) in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS TABLE ({columns}) RETURN {body}")
    return list(made)
