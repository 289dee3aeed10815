"""Configuration: a nested mapping to one small table of categories.  Zero, empty and null values
stand for defaults; unknown keys are ignored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Defaults where the configuration is silent.
DEFAULTS = {"count": 100, "batch_size": 5, "min_score": 0.35, "language": "English", "temperature": 1.0, "top_p": 1.0, "frequency_penalty": 0.0, "presence_penalty": 0.0, "topic_request_count": 20, "cull_max_k": 1000, "judge_threshold": "100"}
SCHEMA = "category string, count int, batch_size int, min_score double, language string, flesch string"


def load(path: str) -> dict:
    """A YAML file, or a JSON one where no YAML reader is installed."""
    try:
        import yaml
    except ImportError:
        import json

        return json.loads(open(path).read())
    return yaml.safe_load(open(path)) or {}


def flag(value) -> bool:
    return str(value).lower() == "true"


def api_params(raw: dict) -> dict:
    given = raw.get("api_params") or {}
    return {k: float(given.get(k) or DEFAULTS[k]) for k in ("temperature", "top_p", "frequency_penalty", "presence_penalty")}


def categories(spark: SparkSession, raw: dict) -> DataFrame:
    """One row for each configured category; a count of 0 switches it off."""
    rows = []
    for name, own in sorted((raw.get("instructors") or {}).items()):
        own = own or {}
        count = own.get("count")
        rows.append(
            (
                name,
                int(raw.get("default_count") or DEFAULTS["count"]) if count is None else int(count),
                int(own.get("batch_size") or raw.get("default_batch_size") or DEFAULTS["batch_size"]),
                float(own.get("min_docsearch_score") or raw.get("min_docsearch_score") or DEFAULTS["min_score"]),
                own.get("language") or raw.get("language") or DEFAULTS["language"],
                str(own["flesch"]) if own.get("flesch") else raw.get("default_flesch"),
            )
        )
    return spark.createDataFrame(rows, SCHEMA)
