"""URL lists as of the time of fetching: every capture meets the entries that were active then.

Dated entries (a key is listed or taken off the list on a day) become intervals of validity; a
capture asks for its host, the domains above it, and its first path segment, each as of its day.
Entries of one key are merged by day first, so a key has at most an interval for every two days,
and the intervals of a key never overlap: a question meets one interval at most. Captures of one
key and day ask the same question, so questions are made distinct before they are joined. Keys
asked by a large part of all captures are few and their answers are broadcast. Built-in functions
only; page contents are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationfield.llm.common import hot_join, stored


def host_of(url: Column) -> Column:
    """The host in lower case; empty where the URL has none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", 1))


def keys_of(url: Column) -> Column:
    """What can be listed for a URL: `d:` and the host or a domain of two labels or more above it,
    `p:` and the host with the first path segment. None for a URL without host."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    first = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)", 1)
    domains = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.concat(F.lit("d:"), F.concat_ws(".", F.slice(labels, i, F.size(labels)))),
    )
    paths = F.when(first != "", F.array(F.concat(F.lit("p:"), host, F.lit("/"), first))).otherwise(F.array().cast("array<string>"))
    return F.when(host != "", F.array_distinct(F.concat(domains, paths))).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """(key, day, listed) to (key, from_day, to_day): listed from the first day, up to but not on the second, or
    from then on where that is null. Days may be numbers of any kind, dates or timestamps.

    On a day with both kinds of entry the listing counts. Null keys or days are left out.
    """
    daily = entries.where(F.col("key").isNotNull() & F.col("day").isNotNull()).groupBy("key", "day").agg(F.max("listed").alias("listed"))
    order = Window.partitionBy("key").orderBy("day")
    turns = daily.withColumn("was", F.lag("listed").over(order)).where(F.coalesce("was", F.lit(False)) != F.col("listed"))
    return (
        turns.withColumn("to_day", F.lead("day").over(order))
        .where("listed").select("key", F.col("day").alias("from_day"), "to_day")
    )


def as_of(captures: DataFrame, listed: DataFrame) -> DataFrame:
    """(id, url, day) to the same with `host`, `n_rules`, `rule` (the longest active key) and `blocked`.

    Rows alike in all three columns stay as many as they are. A capture without a day, or whose
    URL is null or has no host, meets no rule.
    """
    captures = captures.select("id", "url", "day")
    n_rows = captures.count()
    asked = captures.select("id", "url", "day", F.explode(keys_of(F.col("url"))).alias("key"))
    questions = asked.where(F.col("day").isNotNull()).groupBy("key", "day").agg(F.count("*").alias("times"))
    questions = stored(questions, "url-questions")
    answers = questions.join(listed, "key").where(
        (F.col("day") >= F.col("from_day")) & (F.col("to_day").isNull() | (F.col("day") < F.col("to_day")))
    )
    answers = answers.select(F.struct("key", "day").alias("question"), "times", F.col("key").alias("active"))
    asked = asked.dropDuplicates(["id", "url", "day", "key"]).withColumn("question", F.struct("key", "day"))
    met = hot_join(asked, stored(answers, "url-answers"), "question", "times", n_rows).where("active IS NOT NULL")
    best = F.max(F.struct(F.length("active").alias("n"), F.col("active").alias("rule"))).alias("best")
    met = met.groupBy("id", "url", "day").agg(F.count("*").alias("n_rules"), best)
    whose = ["id", "url", "day"]
    same = captures.groupBy(*whose).agg(F.count("*").alias("times")).alias("c").join(
        met.alias("m"), [F.col(f"c.{c}").eqNullSafe(F.col(f"m.{c}")) for c in whose], "left"
    )
    rows = same.select(
        *[F.col(f"c.{c}").alias(c) for c in whose], host_of(F.col("c.url")).alias("host"),
        F.coalesce("n_rules", F.lit(0).cast("long")).alias("n_rules"), F.col("best.rule").alias("rule"),
        F.col("n_rules").isNotNull().alias("blocked"), "times",
    )
    return rows.select("*", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("_")).drop("times", "_")


def allowed(captures: DataFrame, listed: DataFrame) -> DataFrame:
    """The captures (id, url, day) that no active entry matches."""
    return as_of(captures, listed).where("not blocked").select("id", "url", "day")


def _byte(text: Column, i: int) -> Column:
    return F.conv(F.substring(F.md5(text.cast("binary")), 2 * i + 1, 2), 16, 10).cast("int")


def derived_entries(pages: DataFrame, url: str = "url") -> DataFrame:
    """Dated entries for the keys that occur in `pages`: one in four is listed; some are taken off
    and listed again. Which and when follows from a hash of the key."""
    keys = pages.select(F.explode(keys_of(F.col(url))).alias("key")).distinct().where(_byte(F.col("key"), 0) % 4 == 0)
    added = _byte(F.col("key"), 1)
    removed = added + 20 + _byte(F.col("key"), 2) % 60
    again = removed + 10 + _byte(F.col("key"), 3) % 60
    off, back = _byte(F.col("key"), 4) % 2 == 0, _byte(F.col("key"), 5) % 2 == 0
    dated = F.array(
        F.struct(added.alias("day"), F.lit(True).alias("listed")),
        F.struct(F.when(off, removed).alias("day"), F.lit(False).alias("listed")),
        F.struct(F.when(off & back, again).alias("day"), F.lit(True).alias("listed")),
    )
    return keys.select("key", F.inline(dated)).where("day IS NOT NULL")
