"""robots.txt as a dimension table: host, rules, and a vectorised permission test."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.functions.urls import robots_url, url_host

DENY_ALL, ALLOW_ALL = "User-agent: *\nDisallow: /", ""


def robots_rules(responses: DataFrame) -> DataFrame:
    """responses: host, status_code, body -> host, rules. An answer counts as it is, 401 and 403 deny all,
    anything else, errors too, allows all."""
    code = F.col("status_code")
    rules = F.when(code.between(200, 299), F.coalesce("body", F.lit(""))).when(code.isin(401, 403), DENY_ALL).otherwise(ALLOW_ALL)
    return responses.select("host", rules.alias("rules"))


def fetch_robots(urls: DataFrame, fetch: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """urls: url -> host, rules, by asking each host once. An answer that a spent budget left out allows nothing."""
    asked = urls.select(robots_url(F.col("url")).alias("url"), url_host(F.col("url")).alias("host"))
    got = fetch(asked.filter(F.col("url").isNotNull()).dropDuplicates(["host"])).withColumn("body", page_body(F.col("body")))
    spent = F.col("status") == "budget_exhausted"
    return robots_rules(got.withColumn("status_code", F.when(spent, 403).otherwise(F.col("status_code"))))


def page_body(body: Column) -> Column:
    """Bytes or text as text."""
    return F.make_valid_utf8(F.coalesce(body.cast("string"), F.lit("")))


def can_fetch(rules: Column, url: Column, agent: str = "*") -> Column:
    @F.pandas_udf("boolean")
    def allowed(rules: pd.Series, url: pd.Series) -> pd.Series:
        from urllib.robotparser import RobotFileParser

        parsed: dict = {}

        def one(text, address):
            if not text:
                return True
            if text not in parsed:
                parsed[text] = RobotFileParser()
                parsed[text].parse(text.splitlines())
            return parsed[text].can_fetch(agent, address)

        return pd.Series([one(r, u) for r, u in zip(rules, url, strict=True)], dtype=bool)

    return F.when(F.coalesce(rules, F.lit("")) == "", True).otherwise(allowed(rules, url))
