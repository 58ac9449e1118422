"""Where query modules register a plan and the statement that checks it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfline.queries import sqlframes
from shelfline.queries.frames import Frames
from shelfline.session import configure

PLANS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register ``fn(frames) -> DataFrame`` under ``key``.

    ``sql`` may name the shared oracle frames; ``with_frames`` puts the needed common
    table expressions in front once all modules are loaded.
    """

    def register(fn: Callable[[Frames], DataFrame]):
        if key in PLANS:
            raise KeyError(f"query {key} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Frames(configure(spark), sf_dir))

        PLANS[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return register


def with_frames(sql: str) -> str:
    """Prefix a statement with the frames it mentions, dependencies first."""
    wanted: list[str] = []

    def visit(text: str) -> None:
        for name in sqlframes.FRAMES:
            if name not in wanted and re.search(rf"\b{name}\b", text):
                visit(sqlframes.FRAMES[name])
                if name not in wanted:
                    wanted.append(name)

    visit(sql)
    if not wanted:
        return sql
    ctes = ",\n".join(f"{n} AS (\n{sqlframes.FRAMES[n].strip()}\n)" for n in wanted)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
