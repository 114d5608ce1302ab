"""The registered queries once more, as SQL for DuckDB, written independently of the operators."""

from __future__ import annotations

from placemill.plans import fixtures

_GIVEN = {name: name for name in ("customer", "nation", "region", "pages")}
_RAW = f"places_raw AS ({fixtures.PLACES_RAW.format(**_GIVEN)})"
_DUP = f"{_RAW}, places_dup AS ({fixtures.PLACES_DUP.format(places_raw='places_raw')})"

# RE2's \s lacks the vertical tab, so whitespace is spelt out.
_ASCII = r"\t\n\x0B\f\r "
_UNICODE = r"\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"


def _trim(x: str) -> str:
    return f"trim(lower({x}), ' ')"


def _strip(x: str) -> str:
    return f"regexp_replace({_trim(x)}, '[^a-zA-Z0-9.,&{_ASCII}]+', '', 'g')"


def _trim_unicode(x: str) -> str:
    return f"regexp_replace(lower({x}), '^[{_UNICODE}]+|[{_UNICODE}]+$', '', 'g')"


def _strip_unicode(x: str) -> str:
    return f"regexp_replace({_trim_unicode(x)}, '[^a-zA-Z0-9.,&{_UNICODE}]+', '', 'g')"


def _secure(url: str) -> str:
    return f"coalesce(lower({url}) LIKE 'https://%', false)"


def _valid(url: str) -> str:
    starts = f"(lower({url}) LIKE 'http://%' OR lower({url}) LIKE 'https://%')"
    return f"coalesce({starts} AND contains(split_part(lower({url}), '/', 3), '.'), false)"


def _rewrite(url: str, valid: str) -> str:
    return f"CASE WHEN {valid} THEN {url} ELSE regexp_replace({url}, '^(http|https)://', 'https://') END"


_RENAMED = """id, name AS nome, brewery_type AS tipo_cervejaria, address_1 AS endereco_principal,
  address_2 AS endereco_secundario, address_3 AS endereco_alternativo, city AS cidade, state_province AS provincia,
  postal_code AS cep, country AS pais, longitude, latitude, phone AS telefone, website_url AS site, state AS estado,
  street AS rua"""

_FIRST = """first_copies AS (
  SELECT * FROM places_dup QUALIFY row_number() OVER (PARTITION BY id ORDER BY load_seq) = 1)"""

_NORMALISED = f"""{_strip('name')} AS nome, {_strip('city')} AS cidade, {_strip('state')} AS estado,
  {_trim('brewery_type')} AS tipo_cervejaria, {_trim('state_province')} AS provincia, {_trim('country')} AS pais,
  {_trim('street')} AS rua"""


def _clean(source: str) -> str:
    return f"""clean AS (
  SELECT id, {_NORMALISED}, address_1 AS endereco_principal, address_2 AS endereco_secundario,
    address_3 AS endereco_alternativo, postal_code AS cep, longitude, latitude, phone AS telefone,
    website_url AS site, load_seq FROM {source})"""


_IMPUTED_MAX = "coalesce(site, max(site) OVER (PARTITION BY nome))"
_IMPUTED_FILL = """CASE WHEN nome IS NOT NULL THEN coalesce(
  first_value(site IGNORE NULLS) OVER (PARTITION BY nome ORDER BY load_seq
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
  last_value(site IGNORE NULLS) OVER (PARTITION BY nome ORDER BY load_seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) END"""

_FILLED = ", ".join(
    f"coalesce({name}, '-') AS {name}"
    for name in ("endereco_principal", "endereco_secundario", "endereco_alternativo", "cidade", "estado", "site")
)


def _silver(site: str = "site") -> str:
    return f"""{_DUP}, {_FIRST}, {_clean('first_copies')},
sited AS (SELECT * REPLACE ({site} AS site) FROM clean),
filled AS (SELECT * REPLACE ({_FILLED}) FROM sited),
flagged AS (SELECT *, {_valid('site')} AS website_url_validacao, {_secure('site')} AS indicador_seguranca_site
  FROM filled),
silver AS (SELECT * EXCLUDE (load_seq) REPLACE ({_rewrite('site', 'website_url_validacao')} AS site) FROM flagged)"""


_GOLD = "SELECT estado, tipo_cervejaria, count(*) AS count FROM silver GROUP BY ALL"
_GOLD_STORED = "SELECT nullif(estado, '') AS estado, tipo_cervejaria, count(*) AS count FROM silver GROUP BY ALL"


def _dense(table: str, a: str, b: str) -> str:
    return f"""SELECT a.{a}, b.{b}, coalesce(c.n, 0) AS count
FROM (SELECT DISTINCT {a} FROM {table} WHERE {a} IS NOT NULL) a
CROSS JOIN (SELECT DISTINCT {b} FROM {table} WHERE {b} IS NOT NULL) b
LEFT JOIN (SELECT {a}, {b}, count(*) AS n FROM {table} GROUP BY ALL) c ON c.{a} = a.{a} AND c.{b} = b.{b}"""


# The pages before the empty one, which lies two thirds through.
_INGESTED = f"""{_RAW},
last_page AS (SELECT CAST(ceil(ceil(count(*) / 50.0) * 2 / 3.0) AS BIGINT) - 1 AS n FROM customer),
ingested AS (
  SELECT p.*, (CAST(substr(id, 4) AS BIGINT) // 50 + 1) * 4294967296 + CAST(substr(id, 4) AS BIGINT) % 50 AS load_seq
  FROM places_raw p, last_page WHERE CAST(substr(id, 4) AS BIGINT) < n * 50)"""

_SILVER_INGESTED = _silver().replace(_DUP, _INGESTED).replace("places_dup", "ingested")

_TOTAL = f"""{_INGESTED}, announced AS (SELECT count(*) // 2 AS n FROM customer),
needed AS (SELECT i.* FROM ingested i, announced
  WHERE CAST(substr(id, 4) AS BIGINT) < CAST(ceil(n / 50.0) AS BIGINT) * 50)"""
_SILVER_TOTAL = _silver().replace(_DUP, _TOTAL).replace("places_dup", "needed")
_SILVER_BLANK = _silver().replace("coalesce(cidade, '-')", "CASE cidade WHEN '' THEN '?' ELSE coalesce(cidade, '-') END")
_SILVER_BLANK = _SILVER_BLANK.replace("coalesce(estado, '-')", "CASE estado WHEN '' THEN '?' ELSE coalesce(estado, '-') END")
_TAGGED_EVENTS = """tagged AS (SELECT event_id, user_id,
  CASE WHEN event_id % 5 = 0 THEN event_type || '-' || CAST(event_id AS VARCHAR) END AS tag FROM events)"""


def _filled(value: str, group: str, order: str) -> str:
    by = f"OVER (PARTITION BY {group} ORDER BY {order} ROWS BETWEEN"
    return f"""CASE WHEN {group} IS NOT NULL THEN coalesce(
  first_value({value} IGNORE NULLS) {by} CURRENT ROW AND UNBOUNDED FOLLOWING),
  last_value({value} IGNORE NULLS) {by} UNBOUNDED PRECEDING AND CURRENT ROW)) END"""


_UNFILLED = f"{_DUP}, {_clean('places_dup')}"
_GAPPY = """tagged AS (SELECT o_orderkey, o_orderstatus,
  CASE WHEN o_orderkey % 3 <> 0 THEN 'p' || CAST(CAST(trunc(o_totalprice) AS BIGINT) AS VARCHAR) END AS price_tag
  FROM orders)"""
_BY_STATUS = "OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey ROWS BETWEEN"

ORACLES = {
    "rename": f"WITH {_RAW} SELECT {_RENAMED} FROM places_raw",
    "normalise": f"WITH {_RAW} SELECT id, {_NORMALISED} FROM places_raw",
    "normalise_unicode": f"""WITH {_RAW},
wrapped AS (SELECT id, chr(9) || chr(8195) || name || chr(160) || 'x' || chr(31) || chr(10) AS name FROM places_raw)
SELECT id, {_trim_unicode('name')} AS trimmed, {_strip_unicode('name')} AS stripped FROM wrapped""",
    "normalise_documents": f"SELECT doc_id, {_trim('text')} AS trimmed, {_strip('text')} AS stripped FROM documents",
    "normalise_unicode_documents": f"SELECT doc_id, {_strip_unicode('text')} AS stripped FROM documents",
    "fill_constants": f"WITH {_RAW}, renamed AS (SELECT {_RENAMED} FROM places_raw) SELECT id, {_FILLED} FROM renamed",
    "url_flags": f"""WITH {_RAW} SELECT id, website_url, {_valid('website_url')} AS website_url_validacao,
  {_secure('website_url')} AS indicador_seguranca_site FROM places_raw""",
    "url_flags_struct": f"""WITH {_RAW} SELECT id, {_valid('website_url')} AS valida_forma,
  {_secure('website_url')} AS indicador_seguranca_site FROM places_raw""",
    "url_flags_pages": f"SELECT page_id, {_valid('url')} AS valid, {_secure('url')} AS secure FROM pages",
    "rewrite_scheme": f"""WITH {_RAW}
SELECT id, {_rewrite('website_url', _valid('website_url'))} AS site FROM places_raw""",
    "rewrite_scheme_pages": f"""WITH cut AS (SELECT page_id, replace(url, '.', '') AS url FROM pages)
SELECT page_id, {_rewrite('url', _valid('url'))} AS url FROM cut""",
    "union_records": f"""WITH {_RAW} SELECT id, name, phone, NULL AS street FROM places_raw
UNION ALL SELECT id, name, NULL, street FROM places_raw""",
    "dedup_first": f"WITH {_DUP}, {_FIRST} SELECT * FROM first_copies",
    "dedup_any": f"WITH {_DUP} SELECT DISTINCT * EXCLUDE (load_seq, phone) FROM places_dup",
    "dedup_first_lineitem": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1""",
    "dedup_first_events": """SELECT event_id, user_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1""",
    "dedup_first_repeated_order": """SELECT user_id, event_type, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_type, event_id) = 1""",
    "impute_site_max_events": f"""WITH {_TAGGED_EVENTS} SELECT event_id, user_id,
  coalesce(tag, max(tag) OVER (PARTITION BY user_id)) AS tag FROM tagged""",
    "impute_site_fill_events": f"""WITH {_TAGGED_EVENTS}
SELECT event_id, user_id, {_filled('tag', 'user_id', 'event_id')} AS tag FROM tagged""",
    "impute_site_fill_ingested": f"""WITH {_INGESTED}
SELECT id, name, load_seq, {_filled('website_url', 'name', 'load_seq')} AS website_url FROM ingested""",
    "silver_fill_then_impute": f"""WITH {_silver()}
SELECT * REPLACE (CASE WHEN nome IS NOT NULL THEN site END AS site) FROM silver""",
    "silver_empty_to": f"WITH {_SILVER_BLANK} SELECT * FROM silver",
    "medallion_gold_total": f"WITH {_SILVER_TOTAL} {_GOLD_STORED}",
    "medallion_unknown_field": f"""WITH {_INGESTED} SELECT id, CASE WHEN CAST(substr(id, 4) AS BIGINT) % 3 <> 0
  THEN '{{"rating":"' || CAST(CAST(substr(id, 4) AS BIGINT) % 5 AS VARCHAR) || '"}}' END AS other_fields FROM ingested""",
    "medallion_resumed": f"WITH {_SILVER_INGESTED} {_GOLD_STORED}",
    "table_after_failed_write": f"""WITH {_silver()}
SELECT * REPLACE (nullif(estado, '') AS estado) FROM silver""",
    "ingest_pages_unknown_field": f"""WITH {_INGESTED} SELECT *, CASE WHEN CAST(substr(id, 4) AS BIGINT) % 3 <> 0
  THEN CAST(CAST(substr(id, 4) AS BIGINT) % 5 AS VARCHAR) END AS rating FROM ingested""",
    "landing_rejects": f"""WITH {_RAW}
SELECT *, NULL AS line FROM places_raw WHERE CAST(substr(id, 4) AS BIGINT) % 7 <> 0
UNION ALL BY NAME
SELECT '{{"id": "' || id || '"' AS line FROM places_raw WHERE CAST(substr(id, 4) AS BIGINT) % 7 = 0""",
    "first_page_failed": f"""WITH {_INGESTED} SELECT 'up' AS first_page, count(*) AS records FROM ingested
UNION ALL SELECT 'down', 0""",
    "nothing_written_when_empty": """SELECT step, step = 'all' AS wrote, stored
FROM (SELECT count(*) AS stored FROM customer) CROSS JOIN (VALUES ('all'), ('none')) AS steps(step)""",
    "page_files": f"WITH {_INGESTED} SELECT * FROM ingested",
    "dataset_unpartitioned": f"WITH {_RAW} SELECT * FROM places_raw",
    "impute_site_max": f"WITH {_UNFILLED} SELECT id, nome, {_IMPUTED_MAX} AS site, load_seq FROM clean",
    "impute_site_fill": f"WITH {_UNFILLED} SELECT id, nome, {_IMPUTED_FILL} AS site, load_seq FROM clean",
    "impute_site_max_orders": f"""WITH {_GAPPY} SELECT o_orderkey, o_orderstatus,
  coalesce(price_tag, max(price_tag) OVER (PARTITION BY o_orderstatus)) AS price_tag FROM tagged""",
    "impute_site_fill_orders": f"""WITH {_GAPPY} SELECT o_orderkey, o_orderstatus, coalesce(
  first_value(price_tag IGNORE NULLS) {_BY_STATUS} CURRENT ROW AND UNBOUNDED FOLLOWING),
  last_value(price_tag IGNORE NULLS) {_BY_STATUS} UNBOUNDED PRECEDING AND CURRENT ROW)) AS price_tag FROM tagged""",
    "silver": f"WITH {_silver()} SELECT * FROM silver",
    "silver_impute_first": f"WITH {_silver(_IMPUTED_MAX)} SELECT * FROM silver",
    "silver_impute_fill": f"WITH {_silver(_IMPUTED_FILL)} SELECT * FROM silver",
    "silver_struct": f"""WITH {_silver()} SELECT id, site, website_url_validacao AS valid,
  indicador_seguranca_site AS secure FROM silver""",
    "silver_table_two_keys": f"""WITH {_silver()}
SELECT * REPLACE (nullif(estado, '') AS estado, nullif(cidade, '') AS cidade) FROM silver""",
    "gold_count": f"WITH {_silver()} {_GOLD}",
    "gold_count_dense": f"WITH {_silver()} {_dense('silver', 'estado', 'tipo_cervejaria')}",
    "gold_from_table": f"WITH {_silver()} {_GOLD_STORED}",
    "table_partitioned_by_keys": f"WITH {_silver()} {_GOLD_STORED}",
    "medallion_gold": f"WITH {_SILVER_INGESTED} {_GOLD_STORED}",
    "count_documents": "SELECT lang, source, count(*) AS count FROM documents GROUP BY ALL",
    "count_documents_dense": _dense("documents", "lang", "source"),
    "count_events": "SELECT user_id, event_type, count(*) AS count FROM events GROUP BY ALL",
    "count_events_dense": _dense("events", "user_id", "event_type"),
    "count_orders": "SELECT o_orderstatus, o_orderpriority, count(*) AS count FROM orders GROUP BY ALL",
    "count_lineitem": "SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY ALL",
    "page_plan": """SELECT c_custkey, (row_number() OVER (ORDER BY c_custkey) - 1) // 50 + 1 AS page,
  CAST(ceil(count(*) OVER () / 50.0) AS BIGINT) AS total_pages FROM customer""",
    "page_plan_orders": """SELECT o_orderkey, o_totalprice,
  (row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1) // 50 + 1 AS page,
  CAST(ceil(count(*) OVER () / 50.0) AS BIGINT) AS total_pages FROM orders""",
    "global_position_events": """SELECT event_type, user_id,
  row_number() OVER (ORDER BY event_type, user_id) - 1 AS position FROM events""",
    "ingest_pages": f"WITH {_INGESTED} SELECT * FROM ingested",
    "ingest_pages_total": f"""WITH {_INGESTED}, announced AS (SELECT count(*) // 2 AS n FROM customer)
SELECT ingested.* FROM ingested, announced WHERE CAST(substr(id, 4) AS BIGINT) < CAST(ceil(n / 50.0) AS BIGINT) * 50""",
    "landing_roundtrip": f"WITH {_RAW} SELECT * FROM places_raw",
    "dataset_append": f"WITH {_RAW} SELECT * FROM places_raw UNION ALL SELECT * FROM places_raw",
    "dataset_overwrite": f"WITH {_RAW} SELECT * FROM places_raw",
    "documents_by_lang": f"SELECT doc_id, lang, {_trim('text')} AS text FROM documents",
}
