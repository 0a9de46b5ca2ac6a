"""D9 as catalog objects: role views that follow a table of grants and the session's role.

``grants`` says which page a role may open and whether it is limited to the session's school. The views filter their rows by the
grant of the session's role, so a role that is not in the table, or no role, has no rows. The session variables are
read when a query on a view is analysed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

GRANTS = "role string, page string, own_school boolean"
# --- fixed values: pages of the dashboard that a role may open ---------------
DEFAULT_GRANTS = [("director", "rooms", True), ("director", "energy", False), ("director", "solar", False), ("technician", "solar", False)]
# ---------------------------------------------------------------------------


def create(spark: SparkSession, pages: dict[str, DataFrame], school_column: dict[str, str], grants: list[tuple] = DEFAULT_GRANTS) -> None:
    """Views ``secure_<page>`` over the pages' rows; ``school_column`` names the column of a page that holds its school.

    A page without such a column is shown only where the grant is not limited to a school.
    """
    for name in ("wl_role", "wl_school"):
        spark.sql(f"DECLARE OR REPLACE VARIABLE {name} STRING DEFAULT NULL")
    spark.createDataFrame(grants, GRANTS).createOrReplaceTempView("role_grants")
    for page, rows in pages.items():
        rows.createOrReplaceTempView(f"page_{page}")
        grant = f"FROM role_grants g WHERE g.page = '{page}' AND g.role = session.wl_role"
        own = f"p.`{school_column[page]}` = session.wl_school AND (SELECT count(*) {grant}) > 0" if page in school_column else "false"
        # scalar subqueries: the grants are read once, the page's rows are filtered and not joined
        spark.sql(f"""CREATE OR REPLACE TEMPORARY VIEW secure_{page} AS
            SELECT p.* FROM page_{page} p WHERE coalesce((SELECT bool_or(NOT g.own_school) {grant}), false) OR ({own})""")


def read_as(spark: SparkSession, page: str, role: str | None, school: str | None = None) -> DataFrame:
    """A page as a role sees it; the session keeps the role afterwards."""
    spark.sql("SET VAR wl_role = :role", args={"role": role})
    spark.sql("SET VAR wl_school = :school", args={"school": school})
    return spark.table(f"secure_{page}")
