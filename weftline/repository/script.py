"""Control flow of a run as a SQL script: variables, loops over small tables, checks, and a handler that restores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

SWITCH = """
BEGIN
  DECLARE current INT DEFAULT {old};
  DECLARE outcome STRING DEFAULT 'published';
  BEGIN
    DECLARE EXIT HANDLER FOR SQLEXCEPTION
    BEGIN
      SET current = {old};
      SET outcome = 'rolled back';
    END;
    SET current = {new};
    {checks}
  END;
  SELECT current AS version, outcome AS outcome;
END
"""
CHECK = "IF (SELECT count(*) FROM {view} WHERE _version = current AND NOT ({rule})) > 0 THEN SELECT raise_error('{name}'); END IF;"


def switch(spark: SparkSession, versions: dict[int, DataFrame], old: int, new: int, checks: dict[str, str], view: str = "versions") -> DataFrame:
    """The rows that are current after a try to go from one version to another: a rule that a row of the new one breaks brings the old one back.

    The script itself gives one row, as the driver holds what a script gives; the rows are read by their version after it.
    """
    both = None
    for number, df in versions.items():
        df.createOrReplaceTempView(f"{view}_{number}")
        own = spark.sql(f"SELECT *, {number} AS _version FROM {view}_{number}")
        both = own if both is None else both.unionByName(own)
    both.createOrReplaceTempView(view)
    lines = "\n    ".join(CHECK.format(view=view, rule=rule, name=name.replace("'", "''")) for name, rule in checks.items())
    end = spark.sql(SWITCH.format(old=int(old), new=int(new), view=view, checks=lines)).first()
    return versions[end.version].withColumn("outcome", F.lit(end.outcome))


EACH = """
BEGIN
  DECLARE done INT DEFAULT 0;
  DECLARE skipped INT DEFAULT 0;
  FOR one AS SELECT {key} AS k FROM {over} ORDER BY {key} DO
    BEGIN
      DECLARE EXIT HANDLER FOR SQLEXCEPTION SET skipped = skipped + 1;
      EXECUTE IMMEDIATE '{step}' USING one.k AS k;
      SET done = done + 1;
    END;
  END FOR;
  SELECT done, skipped;
END
"""


def each(spark: SparkSession, over: str, key: str, step: str) -> DataFrame:
    """Run a statement with parameter :k for each row of a small table (datasets, projects); one that fails is skipped and counted."""
    return spark.sql(EACH.format(over=over, key=key, step=step.replace("'", "''")))
