"""What a statement may read and do: column policies, and the actions of a statement before it runs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

#: The commands that statements are parsed to, and the actions that they stand for.
ACTIONS = {
    "InsertIntoStatement": "insert", "DeleteFromTable": "delete", "UpdateTable": "update", "MergeIntoTable": "update", "CreateTable": "create_table",
    "CreateTableAsSelect": "create_table", "CreateView": "create_view", "CreateViewCommand": "create_view", "DropTable": "drop_table", "DropView": "drop_view",
    "TruncateTable": "delete", "RenameTable": "alter_table", "AddColumns": "alter_table", "DropColumns": "alter_table", "SetCommand": "pragma",
}
QUERIES = {"Project", "Filter", "Aggregate", "Sort", "GlobalLimit", "LocalLimit", "Distinct", "Union", "UnresolvedWith", "UnresolvedInlineTable", "UnresolvedHaving", "SubqueryAlias", "UnresolvedRelation"}


class Denied(PermissionError):
    """A column or an action that the policy denies."""


def secured(rows: DataFrame, table: str, policy: Callable[[str, str], str]) -> DataFrame:
    """rows as policy(table, column) lets them be read: allow, ignore (null in its place) or deny (raises); any other answer denies."""
    out = []
    for f in rows.schema:
        answer = policy(table, f.name)
        if answer not in ("allow", "ignore"):
            raise Denied(f"{table}.{f.name}")
        out.append(F.col(f"`{f.name}`") if answer == "allow" else F.lit(None).cast(f.dataType).alias(f.name))
    return rows.select(*out)


def action_of(spark: SparkSession, sql: str) -> str:
    """The action of a statement, as Spark parses it; unknown where it isn't one of those above."""
    node = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).getClass().getSimpleName()
    return "select" if node in QUERIES else ACTIONS.get(node, "unknown")


def authorized(spark: SparkSession, sql: str, allowed: set[str]) -> DataFrame:
    """Runs sql if its action is allowed; an unknown one never is."""
    if (action := action_of(spark, sql)) not in allowed or action == "unknown":
        raise Denied(action)
    return spark.sql(sql)
