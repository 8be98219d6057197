"""Input frames of the registered queries, all over the whole given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from veilspark.sources.tables import spread

# A wide table of invented people, one row per customer.  Runs unchanged in
# Spark SQL and in DuckDB.
PEOPLE_SELECT = """
select c_custkey as row_id,
 concat(split_part('John,Jane,Bob,Alice,Charlie,Diana,Frank,Grace',',',cast(c_custkey % 8 + 1 as int)),' ',split_part('Doe,Smith,Johnson,Brown,Wilson,Lee,Miller',',',cast(c_custkey % 7 + 1 as int))) as name,
 concat('user',cast(c_custkey as string),'@mail',cast(c_custkey % 5 as string),'.example.com') as email,
 concat(cast(200 + c_custkey % 700 as string),'-',lpad(cast(c_custkey % 1000 as string),3,'0'),'-',lpad(cast((c_custkey * 37) % 10000 as string),4,'0')) as phone,
 concat(cast(c_custkey % 900 + 1 as string),' ',split_part('Main St,Oak Ave,Pine Rd,Elm Drive',',',cast(c_custkey % 4 + 1 as int)),' Springfield ',lpad(cast(10000 + (c_custkey * 7) % 89999 as string),5,'0')) as address,
 case when c_custkey % 3 = 0 then concat('SSN: ',lpad(cast(1 + c_custkey % 665 as string),3,'0'),'-',lpad(cast(1 + c_custkey % 99 as string),2,'0'),'-',lpad(cast(1 + c_custkey % 9999 as string),4,'0'))
      when c_custkey % 3 = 1 then concat('Ref 7 ',lpad(cast(1 + c_custkey % 665 as string),3,'0'),'-',lpad(cast(1 + c_custkey % 99 as string),2,'0'),'-',lpad(cast(1 + c_custkey % 9999 as string),4,'0')) end as ssn,
 case when c_custkey % 4 = 0 then concat('4',lpad(cast(c_custkey as string),15,'0')) when c_custkey % 4 = 1 then concat('4532-1234-5678-',lpad(cast(c_custkey % 10000 as string),4,'0')) end as card,
 case c_custkey % 6 when 0 then concat('Patient, diagnosis pending, born ',lpad(cast(c_custkey % 12 + 1 as string),2,'0'),'/',lpad(cast(c_custkey % 28 + 1 as string),2,'0'),'/',cast(1950 + c_custkey % 50 as string))
   when 1 then concat('IP: 192.168.',cast(c_custkey % 256 as string),'.1') when 2 then 'Works at Acme Data Corp' when 3 then 'Salary and bank account number on file, billing phone, home address, employer, manager' when 4 then concat('zip ',lpad(cast(10000 + c_custkey % 80000 as string),5,'0'),' Acme Data Corp') end as notes,
 c_acctbal as balance
"""

PEOPLE_TEXT = ["name", "email", "phone", "address", "ssn", "card", "notes"]

# Dictionary of the gazetteer queries: fixed terms, and every clause of every benchmark
# item that has two words or more, whole.  The clauses are cut alike in both engines.
FIXED_TERMS = [
    ("Apache License", "ORG"), ("General Public", "ORG"), ("Orre", "GPE"), ("Acme Data Corp", "EMPLOYER"),
    ("Main St", "ADDRESS"), ("Oak Ave Springfield", "ADDRESS"), ("Springfield", "GPE"), ("diagnosis pending", "ORG"),
]
CLAUSE_BREAK = r"[.,;:!?\n]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").selectExpr("doc_id as row_id", "text"), "row_id")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = PEOPLE_SELECT.strip().removeprefix("select ")
    source = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return spark.sql(f"select {columns} from {{src}}", src=spread(source, "c_custkey"))


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    clauses = table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", CLAUSE_BREAK)).alias("term")).distinct()
    words = F.size(F.regexp_extract_all("term", F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))
    kind = F.element_at(F.array(*[F.lit(x) for x in ("LOC", "PERSON", "ORG")]), words % 3 + 1)
    clauses = clauses.filter(words >= 2).select("term", kind.alias("label"))
    return clauses.unionByName(spark.createDataFrame(FIXED_TERMS, "term string, label string"))


def part_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that stand next to each other in an order: a graph that is no union of cliques."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    after = lines.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("l_partkey").alias("dst"))
    return lines.join(after, ["l_orderkey", "l_linenumber"]).select(F.col("l_partkey").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"))


def turn_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn of a conversation with the next one."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    after = turns.select("conv_id", (F.col("turn") - 1).alias("turn"))

    def node(step: int):
        return F.format_string("%08d:%06d", F.col("conv_id").cast("long"), F.col("turn").cast("long") + step)

    return turns.join(after, ["conv_id", "turn"]).select(node(0).alias("src"), node(1).alias("dst"))
