"""Pages printed from the order tables, so that what is extracted can be checked.

Every page is made from one order and its customer, nation and region, by a projection:
no order's pages depend on another row, and nothing is gathered.  Two documents share the
orders; one holds two thirds of all pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Page positions: eight slots per order, repeated pages far behind all others.
SLOTS = 8
REPEAT_AT = 1 << 40

BASE_SQL = """
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'vol-b' ELSE 'vol-a' END AS doc_id,
       c_name, o_orderpriority AS priority, n_name, r_name, c_mktsegment AS segment,
       o_orderstatus AS status, o_custkey AS custkey,
       CAST(year(o_orderdate) AS STRING) AS yr
FROM {orders} o
JOIN {customer} c ON o.o_custkey = c.c_custkey
JOIN {nation} n ON c.c_nationkey = n.n_nationkey
JOIN {region} r ON n.n_regionkey = r.r_regionkey
"""

_ROW = """concat(k, ' - ', i,
  CASE (k + i) % 4 WHEN 0 THEN '' WHEN 1 THEN ' 38' WHEN 2 THEN ' 308 WIN' ELSE concat('  ', segment) END,
  ' ', i + k % 10, ' ', 100 + k % 500,
  CASE (k + i) % 4 WHEN 0 THEN ' Antique' WHEN 1 THEN ' Restricted para. 12(3)'
    WHEN 2 THEN ' CC 84(3) Exempted Non-Commercial 7 para.' ELSE '' END)"""

_PAGE_1 = f"""concat(
  'Header of volume ', doc_id, '\\n',
  'Firearm Reference Number (FRN): ', k, '\\n',
  'Make: ', c_name, '\\n',
  'Model:  ', replace(priority, '-', ' -  '), ' \\n',
  'Manufacturer: ', n_name,
  IF(k % 11 = 0, concat(' Country of Manufacturer: ', r_name), concat('\\nCountry of Manufacturer: ', r_name)), '\\n',
  'Level: ', IF(k % 3 = 0, 'No Data', segment), '\\n',
  'Type: ', IF(k % 13 = 0, '', status), '\\n',
  'Action: first ', status, '\\n',
  'Legal Classification: ', CASE status WHEN 'F' THEN 'Restricted' WHEN 'O' THEN 'Antique' ELSE 'Prohibited' END, '\\n',
  'Serial Numbering: ', IF(k % 9 = 0, 'See Note', concat('serial ', k)), '\\n',
  'Year Dates: ', IF(k % 5 = 0, 'See Note', yr), '\\n',
  IF(k % 7 = 0, '', concat('Importer: Importer ', custkey, '\\n')),
  IF(k % 4 = 0, '', concat(
    'Calibre, Shots and Barrel Length\\n',
    array_join(transform(sequence(1, CAST(k % 4 AS INT)), i -> {_ROW}), '\\n'),
    '\\n', k, ' - 9 broken row 5 of x\\n')),
  IF(k % 5 = 0, concat('Notes\\nyear dates: ', yr, '\\n'), '')
)"""

_PAGE_2 = """concat(
  'Firearm Reference Number (FRN): ', k, '\\n',
  'Action: second ', status, '\\n',
  'Notes\\nstray line before the first heading\\n',
  'Make - marked ', c_name, '\\n',
  'Legal LAW Comments -- first\\n',
  array_join(transform(
    IF((k / 2) % 4 < 1, array(), sequence(1, CAST((k DIV 2) % 4 AS INT))),
    i -> concat('- bullet ', i, ' of ', k, '\\n')), ''),
  'wrapped tail\\n',
  IF(k % 10 = 4, concat('Make - again\\n- ', status, '\\n'), ''),
  'Cross-References\\n',
  k + 1, '  ', c_name, '\\n', 'no reference row\\n', k + 2, ' ', segment, '\\n',
  'Firearms Reference Table page ', k, '\\n9 not a row\\n'
)"""



def _slot(offset: str, text: str, here: str) -> str:
    return f"named_struct('page_idx', {offset} + k * {SLOTS}, 'text', {text}, 'here', {here})"


_SLOTS = ",\n".join((
    _slot("0", "page_1", "true"),
    _slot("1", "page_2", "k % 2 = 0"),
    _slot("2", "CAST(NULL AS STRING)", "k % 50 = 0"),
    _slot("3", "'General remarks\\nNo key is printed here.'", "k % 60 = 0"),
    _slot("4", "concat('Firearm Reference Number (FRN): ', k, ' - 1\\nMake: sub page')", "k % 70 = 0"),
    _slot(str(REPEAT_AT), "page_1", "k % 97 = 0"),
))

PAGES_SQL = f"""
WITH printed AS (SELECT *, {_PAGE_1} AS page_1, {_PAGE_2} AS page_2 FROM ({BASE_SQL}))
SELECT doc_id, CAST(page_idx AS BIGINT) AS page_idx, text
FROM (SELECT doc_id, inline(array({_SLOTS})) FROM printed) WHERE here
"""

# One table page per line item: no grouping, every row of the table is printed.
LINE_PAGES_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, concat(
  'Calibre, Shots and Barrel Length\\n',
  '  ', l_orderkey, ' -', l_linenumber, ' ', IF(l_partkey % 4 = 0, CAST(p_size AS STRING), p_type),
  ' ', CAST(l_quantity AS INT), ' ', l_suppkey, ' ',
  CASE l_returnflag WHEN 'A' THEN 'Antique' WHEN 'N' THEN 'Restricted'
    ELSE 'CC 84(3) Exempted para. 5 6x' END, '\\n',
  l_orderkey, ' - 0 no adjacent 5 x 6 digits\\n',
  l_orderkey, '- 99 ', l_partkey, ' ', l_suppkey, '\\n',
  'Importer: x\\n', l_orderkey, ' - 1 after 1 2 closing\\n') AS text
FROM {lineitem} l JOIN {part} p ON l.l_partkey = p.p_partkey
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dealt(df: DataFrame, *key: str) -> DataFrame:
    """Rows dealt by key to as many tasks as the scan has or the cluster runs at once; a number given is not coalesced."""
    tasks = max(df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(tasks, *key)


def base_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BASE_SQL, **_dims(spark, sf_dir))


def _dims(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    dims = {n: table(spark, sf_dir, n) for n in ("customer", "nation", "region")}
    return {"orders": dealt(table(spark, sf_dir, "orders"), "o_orderkey"), **dims}


def rendered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(PAGES_SQL, **_dims(spark, sf_dir))


def line_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(
        LINE_PAGES_SQL, lineitem=dealt(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber"), part=table(spark, sf_dir, "part"))
