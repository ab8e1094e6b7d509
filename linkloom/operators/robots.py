"""Robots policies as tables: bodies to ordered rules, rules to a decision per URL.

Group and matching rules are those of Python's ``urllib.robotparser``: no wildcards, and the first
matching rule wins, not the longest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.session import own_side

_LINE_END = r"\R|[\x1c-\x1e]"
_EDGE_BLANKS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, _EDGE_BLANKS, "")


def unquote(text: Column) -> Column:
    """%XX escapes decoded; a percent sign that starts no escape, and a plus, stay."""
    safe = F.regexp_replace(
        F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"), r"\+", "%2B"
    )
    return F.when(text.contains("%"), F.url_decode(safe)).otherwise(text)


def _no_empty_query(path: Column) -> Column:
    return F.regexp_replace(path, r"^([^?]*)\?\z", "$1")


def _answered(status: Column) -> Column:
    return (status >= 200) & (status < 300)


def _rank(status: Column, body: Column) -> Column:
    """How much an answer says: rules, then a good answer without a body, 4xx, 5xx, any other status, none."""
    return (
        F.when(_answered(status), F.when(body.isNotNull(), 0).otherwise(1))
        .when((status >= 400) & (status < 500), 2)
        .when((status >= 500) & (status < 600), 3)
        .when(status != 0, 4)
        .otherwise(5)
    )


def one_answer(robots: DataFrame) -> DataFrame:
    """One robots answer per host, of several copies the one that says most: 2xx with a body before 2xx
    without, then 4xx, 5xx and other statuses, and no answer (0 or NULL) only where there is no other.
    In a class the least status and then the least body, so the choice does not depend on order.

    Copies shrink to one row per task before the shuffle, and the later steps, all by host, reuse
    this partitioning.
    """
    rank = _rank(F.col("status"), F.col("body")).alias("rank")
    answer = F.min(F.struct(rank, "status", "body")).alias("answer")
    return robots.groupBy("host").agg(answer).select("host", "answer.status", "answer.body")


def _group_rows(robots: DataFrame) -> DataFrame:
    """Members of every group that counts, with the group's ``agents``; ``allow`` is NULL for a non-path
    member."""
    lines = one_answer(robots).filter(_answered(F.col("status"))).select(
        "host", F.posexplode(F.split("body", _LINE_END, -1)).alias("line_no", "raw")
    )
    text = _strip(F.regexp_replace("raw", r"(?s)#.*\z", ""))
    field = F.lower(_strip(F.regexp_extract(text, r"(?s)^([^:]*):", 1)))
    value = unquote(_strip(F.regexp_extract(text, r"(?s)^[^:]*:(.*)\z", 1)))
    kind = (
        F.when(F.col("raw") == "", "blank")
        .when(field == "user-agent", "agent")
        .when(field.isin("allow", "disallow", "crawl-delay", "request-rate"), "member")
    )
    events = lines.select(
        "host",
        F.col("line_no").cast("bigint").alias("line_no"),
        kind.alias("kind"),
        field.alias("field"),
        value.alias("value"),
    ).filter(F.col("kind").isNotNull())

    # One host's window holds the lines of one robots.txt.
    by_line = Window.partitionBy("host").orderBy("line_no")
    so_far = by_line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    follows_agent = F.lag("kind", 1, "").over(by_line) == "agent"
    opens = (F.col("kind") == "agent") & ~follows_agent
    open_now = F.when(F.col("kind") == "agent", True).when(F.col("kind") == "blank", False)
    grouped = events.select(
        "*",
        F.sum(opens.cast("bigint")).over(so_far).alias("group_ord"),
        F.last(open_now, ignorenulls=True).over(so_far).alias("_open"),
    )
    in_group = Window.partitionBy("host", "group_ord")
    named = F.collect_set(F.when(F.col("kind") == "agent", F.lower("value"))).over(in_group)
    path_rule = F.col("field").isin("allow", "disallow")
    return (
        grouped.withColumn("_agents", named)
        .filter((F.col("kind") == "member") & F.col("_open"))
        .select(
            "host",
            "group_ord",
            F.col("_agents").alias("agents"),
            F.col("line_no").alias("rule_ord"),
            F.when(path_rule, (F.col("field") == "allow") | (F.col("value") == "")).alias("allow"),
            F.when(path_rule, _no_empty_query(F.col("value"))).alias("prefix"),
        )
    )


def robots_rules(robots: DataFrame) -> DataFrame:
    """Rules of ``robots(host, status, body)``: ``host, group_ord, agent, rule_ord, allow, prefix``.

    Consecutive User-agent lines open one group; a rule belongs to the group open above it. An empty
    line, or a User-agent line after a rule, ends the group. Agents with no rule before an empty
    line are dropped, rules before any agent are ignored, comments are cut (a line that was only a
    comment is not empty), an empty Disallow allows all. A row is one (agent, rule) pair: a group
    under two agents is listed for both.
    """
    rules = _group_rows(robots).filter(F.col("allow").isNotNull())
    return rules.select(
        "host", "group_ord", F.explode("agents").alias("agent"), "rule_ord", "allow", "prefix"
    )


def host_policies(robots: DataFrame, user_agent: str) -> DataFrame:
    """One row per host: ``deny_all``, or the ``rules`` that apply to ``user_agent`` in order.

    The first group naming a part of the agent's product token applies, else the first group with
    ``*``; a chosen group never falls through. The group is chosen on its list of agents, so no rule is
    repeated for each of them. 401 and 403 deny all, other 4xx allow all; ``deny_all`` is NULL where
    robots.txt gave no answer. A host's rules come from one robots.txt, so they fit one short array
    and deciding a URL multiplies no rows.
    """
    token = F.lit(user_agent.split("/")[0].lower())
    is_default = F.array_contains("agents", "*")
    is_named = F.exists("agents", lambda a: F.contains(token, a))
    groups = (
        _group_rows(robots)
        .filter(is_default | is_named)
        .groupBy("host", "group_ord")
        .agg(
            F.bool_or(is_default).alias("is_default"),
            F.sort_array(
                F.collect_list(
                    F.when(F.col("allow").isNotNull(), F.struct("rule_ord", "allow", "prefix"))
                )
            ).alias("rules"),
        )
    )
    chosen = groups.groupBy("host").agg(
        F.min_by("rules", F.struct("is_default", "group_ord")).alias("rules")
    )
    status = F.col("status")
    verdict = (
        F.when(_answered(status), False)
        .when(status.isin(401, 403), True)
        .when((status >= 400) & (status < 500), False)
    )
    hosts = one_answer(robots).select("host", verdict.alias("deny_all"))
    return hosts.join(chosen, "host", "left")


def decision(url: Column, deny_all: Column, rules: Column) -> Column:
    """Allow or not: the first rule whose prefix starts the path and query decides, none allows."""
    tail = F.regexp_replace(unquote(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?", "")
    target = F.when(tail == "", "/").otherwise(_no_empty_query(tail))
    hit = F.get(F.filter(rules, lambda r: target.startswith(r["prefix"])), F.lit(0))
    return ~deny_all & F.coalesce(hit["allow"], F.lit(True))


def robots_verdicts(
    candidates: DataFrame,
    robots: DataFrame,
    user_agent: str,
    url: str = "url",
    domain: str = "domain",
) -> DataFrame:
    """Candidates with ``if_deny`` and ``if_allow``: the verdict when a host without an answer, or without
    a robots row, denies all, and when it allows all. A URL without host is refused.

    One equi-join on the host, whose other side has one row per host.
    """
    policy = host_policies(robots, user_agent).withColumnRenamed("host", domain)
    joined = candidates.join(own_side(policy), domain, "left")
    has_host = F.col(domain) != ""

    def verdict(deny: bool) -> Column:
        return has_host & decision(F.col(url), F.coalesce("deny_all", F.lit(deny)), F.col("rules"))

    return joined.withColumns({"if_deny": verdict(True), "if_allow": verdict(False)}).drop(
        "deny_all", "rules"
    )


def robots_filter(
    candidates: DataFrame,
    robots: DataFrame,
    user_agent: str,
    on_unreachable: str = "deny",
    url: str = "url",
    domain: str = "domain",
) -> DataFrame:
    """Candidates with ``allowed``, the verdict for one reading of hosts without an answer."""
    wanted, other = ("if_deny", "if_allow") if on_unreachable == "deny" else ("if_allow", "if_deny")
    both = robots_verdicts(candidates, robots, user_agent, url, domain)
    return both.withColumnRenamed(wanted, "allowed").drop(other)
