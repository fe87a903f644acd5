"""Entity tables derived from documents. The same SQL runs in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "fx_base": """SELECT doc_id, lang, upper(source) AS src, split_part(t,' ',1) AS w1, split_part(t,' ',2) AS w2, split_part(t,' ',3) AS w3, split_part(t,' ',4) AS w4, split_part(t,' ',5) AS w5,
  CASE doc_id % 5 WHEN 0 THEN ' Inc' WHEN 1 THEN ' Pvt. Ltd.' WHEN 2 THEN ' LLC' WHEN 3 THEN ' & Co' ELSE '' END AS sfx,
  CASE doc_id % 4 WHEN 0 THEN ' St' WHEN 1 THEN ' Rd' WHEN 2 THEN ' Ave' ELSE ' Blvd' END AS way, CAST(doc_id * 37 % 990 + 10 AS STRING) AS num
  FROM (SELECT doc_id, lang, source, translate(text, chr(10), ' ') AS t FROM documents) d""",
    "fx_source1": """SELECT concat('S1-', CAST(doc_id AS STRING)) AS entity_id, concat(w1,' ',w2,' ',w3,sfx) AS business_name, concat(num,' ',w4,way,', ',w5,', ',src) AS business_address,
  CASE lang WHEN 'en' THEN 'US' WHEN 'fr' THEN 'France' ELSE 'India' END AS country FROM fx_base""",
    "fx_source2": """SELECT concat('S2-', CAST(doc_id * 10 + k AS STRING)) AS entity_id, CASE WHEN k = 0 THEN upper(replace(concat(w1,' ',w2,' ',w3,sfx),'ß','ss')) ELSE concat(w1,'  ',w3,sfx) END AS business_name,
  CASE WHEN doc_id % 29 = 0 THEN '' ELSE upper(replace(concat(num,' ',w4,way,', ',w5),'ß','ss')) END AS business_address, CASE lang WHEN 'en' THEN 'usa' WHEN 'fr' THEN 'FR' ELSE 'ind' END AS country
  FROM fx_base CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k) c WHERE doc_id % 18 <> 0 AND (k = 0 OR doc_id % 4 = 0)""",
    "fx_source3": """SELECT concat('S3-', CAST(doc_id * 10 AS STRING)) AS entity_id, concat(w3,' ',w1,' ',w2) AS business_name, CASE WHEN doc_id % 31 = 0 THEN '' ELSE concat(src,', ',w5,' ',num,' ',w4,way) END AS business_address,
  CASE lang WHEN 'en' THEN 'United States' WHEN 'fr' THEN 'fra' ELSE 'India' END AS country FROM fx_base WHERE doc_id % 18 <> 0 AND doc_id % 7 <> 0""",
    "fx_gt_pairs": """SELECT concat('S1-', CAST(doc_id AS STRING)) AS s1_id, concat('S2-', CAST(doc_id * 10 + k AS STRING)) AS cand_id
  FROM documents CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 AS k) c WHERE doc_id % 18 <> 0 AND (k = 0 OR doc_id % 4 = 0)
  UNION ALL SELECT concat('S1-', CAST(doc_id AS STRING)), concat('S3-', CAST(doc_id * 10 AS STRING)) FROM documents WHERE doc_id % 18 <> 0 AND doc_id % 7 <> 0""",
}

#: A broken ID-list file, a line or two for each document: what the validator must find.
LIST_LINES = """SELECT CASE doc_id % 17 WHEN 0 THEN concat('S1-', id, chr(9)) WHEN 1 THEN concat('no tab at ', id) WHEN 2 THEN concat('S1-', id, chr(9), 'S2-', id, '0,S2-', id, '0') WHEN 3 THEN concat('S1-', id, chr(9), 'S1-', id, ',S2-', id, '0')
  WHEN 4 THEN concat('S1-', id, chr(9), 'X9-1,S2-', id, '0') WHEN 5 THEN concat('S1-', id, chr(9), ' S2-', id, '0') WHEN 6 THEN concat('S1-', id, chr(9), 'S2-', id, '0', chr(9), 'S3-', id, '0') WHEN 7 THEN concat(' S1-', id, chr(9), 'S2-', id, '0,,S3-', id, '0')
  WHEN 8 THEN concat('S1-9999', id, chr(9), 'S2-', id, '0') WHEN 9 THEN concat('S1-', id, chr(9), 'S2-9999', id) WHEN 10 THEN '  ' ELSE concat('S1-', id, chr(9), 'S2-', id, '0,S3-', id, '0') END AS value
  FROM (SELECT doc_id, CAST(doc_id AS STRING) AS id FROM documents) d WHERE doc_id % 41 <> 0
  UNION ALL SELECT concat('S1-', CAST(doc_id AS STRING), chr(9), 'S2-', CAST(doc_id AS STRING), '0') FROM documents WHERE doc_id % 13 = 0"""


def view(spark: SparkSession, sf_dir: str, name: str, base: DataFrame | None = None) -> DataFrame:
    """base: the written rows of fx_base, so that the texts are not split again for each source."""
    if base is not None and name in ("fx_source1", "fx_source2", "fx_source3"):
        return spark.sql(VIEWS[name].replace("FROM fx_base", "FROM {base}"), base=base)
    parts = [f"documents AS (SELECT doc_id, text, lang, source FROM parquet.`{sf_dir}/documents.parquet`)"]
    if name not in ("fx_base", "fx_gt_pairs"):
        parts.append(f"fx_base AS ({VIEWS['fx_base']})")
    return spark.sql(f"WITH {', '.join(parts)} {VIEWS[name]}")


def ctes() -> str:
    """The views as CTEs over a table documents."""
    return ",\n".join(f"{name} AS ({sql})" for name, sql in VIEWS.items())


def list_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value) of LIST_LINES."""
    return spark.sql(f"WITH documents AS (SELECT doc_id FROM parquet.`{sf_dir}/documents.parquet`) {LIST_LINES}")
