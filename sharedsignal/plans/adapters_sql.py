"""SQL twins of the adapter views (DuckDB dialect, also valid Spark SQL where noted).

``with_adapters(body, *views)`` prefixes a query with the CTEs it needs, in
dependency order, so each oracle string is self-contained over the driver's
pre-registered tables.
"""

from __future__ import annotations

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    CTES[name] = (deps, sql)


_cte("ss_agg", (), """
SELECT l_suppkey % 12 AS st, l_partkey AS pk,
       min(l_discount) AS min_disc, min(l_tax) AS min_tax,
       min(l_extendedprice) AS min_price, min(l_quantity) AS min_qty
FROM lineitem GROUP BY l_suppkey % 12, l_partkey""")

_cte("ss_st", ("ss_agg",), """
SELECT st,
  CASE st % 3 WHEN 0 THEN 'gwas' WHEN 1 THEN 'eqtl' ELSE 'pqtl' END AS type,
  concat(CASE WHEN st = 6 THEN 'FINNGEN_S' ELSE 'S' END, CAST(st AS VARCHAR)) AS study_id,
  CASE st % 3 WHEN 0 THEN CAST(NULL AS VARCHAR)
       WHEN 1 THEN concat('ENSG', lpad(CAST(st AS VARCHAR), 11, '0'))
       ELSE concat('PROT_', CAST(st AS VARCHAR)) END AS phenotype_id,
  CASE WHEN st % 3 = 0 THEN CAST(NULL AS VARCHAR) ELSE concat('TISSUE_', CAST(st % 5 AS VARCHAR)) END AS bio_feature,
  CAST(pk % 22 + 1 AS VARCHAR) AS chrom,
  CAST(pk * 200 AS BIGINT) AS pos,
  substr('ACGT', CAST(pk % 4 + 1 AS INTEGER), 1) AS ref,
  substr('CGTA', CAST(pk % 4 + 1 AS INTEGER), 1) AS alt,
  CAST(min_disc - 0.05 AS DOUBLE) AS beta,
  CAST(0.01 + min_tax AS DOUBLE) AS se,
  CAST(CAST(power(10.0, -min_price / 10000) AS FLOAT) AS DOUBLE) AS pval,
  CAST(1000 + 10 * st AS INTEGER) AS n_total,
  CASE WHEN st % 2 = 0 THEN CAST(floor(CAST(1000 + 10 * st AS INTEGER) / 4) AS INTEGER) END AS n_cases,
  CAST(min_qty / 51 AS DOUBLE) AS eaf,
  (st % 2 = 0) AS is_cc
FROM ss_agg""")

_cte("sumstats", ("ss_st",), """
SELECT type, study_id, phenotype_id, bio_feature, chrom, pos, ref, alt, beta, se, pval,
       n_total, n_cases, eaf, is_cc FROM ss_st""")

_cte("toploci", ("sumstats",), """
SELECT study_id, phenotype_id, bio_feature, chrom, pos, ref, alt,
       concat_ws(':', chrom, CAST(pos AS VARCHAR), ref, alt) AS variant_id, pval
FROM (SELECT *, row_number() OVER (PARTITION BY study_id, phenotype_id, bio_feature, chrom, pos // 150000
                                   ORDER BY pval, pos) AS rn FROM sumstats WHERE pval <= 1e-2) t
WHERE rn = 1""")

_cte("credset", ("ss_st", "toploci"), """
SELECT s.type, s.study_id, s.phenotype_id, s.bio_feature,
       t.chrom AS lead_chrom, t.pos AS lead_pos, t.ref AS lead_ref, t.alt AS lead_alt,
       s.chrom AS tag_chrom, s.pos AS tag_pos, s.ref AS tag_ref, s.alt AS tag_alt,
       s.pval <= 1e-3 AS is95_credset, s.pval <= 1e-2 AS is99_credset,
       CASE s.st % 4 WHEN 3 THEN 'distance' ELSE 'conditional' END AS multisignal_method
FROM ss_st s JOIN toploci t
  ON s.study_id = t.study_id AND s.chrom = t.chrom
 AND s.phenotype_id IS NOT DISTINCT FROM t.phenotype_id
 AND s.bio_feature IS NOT DISTINCT FROM t.bio_feature
 AND abs(CAST(s.pos AS BIGINT) - CAST(t.pos AS BIGINT)) <= 500000
WHERE s.pval <= 1e-2""")

_cte("genotypes", (), """
SELECT sample_id, CAST(pk % 22 + 1 AS VARCHAR) AS chrom, CAST(pk * 200 AS BIGINT) AS pos,
       substr('ACGT', CAST(pk % 4 + 1 AS INTEGER), 1) AS ref,
       substr('CGTA', CAST(pk % 4 + 1 AS INTEGER), 1) AS alt, dosage
FROM (SELECT o.o_custkey AS sample_id, l.l_partkey AS pk,
             CAST(max(l.l_linenumber % 3) AS INTEGER) AS dosage
      FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
      GROUP BY o.o_custkey, l.l_partkey) g
WHERE dosage > 0""")

_cte("pheno_gene", ("ss_st",), """
SELECT concat('PROT_', CAST(st AS VARCHAR)) AS phenotype_id,
       concat('ENSG', lpad(CAST(100 + st AS VARCHAR), 11, '0')) AS gene_id
FROM (SELECT DISTINCT st FROM ss_st WHERE st % 3 = 2) a
UNION ALL
SELECT concat('PROT_', CAST(st AS VARCHAR)) AS phenotype_id,
       concat('NOTGENE_', CAST(st AS VARCHAR)) AS gene_id
FROM (SELECT DISTINCT st FROM ss_st WHERE st % 3 = 2) b""")


def register(name: str, deps: tuple[str, ...], sql: str) -> None:
    """Add a derived CTE (used by the oracle module for composite steps)."""
    _cte(name, deps, sql)


def _order(views) -> list[str]:
    seen: list[str] = []

    def visit(v):
        if v in seen:
            return
        for d in CTES[v][0]:
            visit(d)
        seen.append(v)

    for v in views:
        visit(v)
    return seen


def with_adapters(body: str, *views: str) -> str:
    names = _order(views)
    if not names:
        return body.strip()
    parts = ",\n".join(f"{n} AS ({CTES[n][1].strip()})" for n in names)
    return f"WITH {parts}\n{body.strip()}"
