"""Column names and types of the three layers."""

from __future__ import annotations

from pyspark.sql import types as T

# The source's field names and the names silver gives them. Results depend on the exact spelling.
RENAMES = {
    "id": "id",
    "name": "nome",
    "brewery_type": "tipo_cervejaria",
    "address_1": "endereco_principal",
    "address_2": "endereco_secundario",
    "address_3": "endereco_alternativo",
    "city": "cidade",
    "state_province": "provincia",
    "postal_code": "cep",
    "country": "pais",
    "longitude": "longitude",
    "latitude": "latitude",
    "phone": "telefone",
    "website_url": "site",
    "state": "estado",
    "street": "rua",
}

# What a missing value becomes, and the columns where it does.
MISSING = "-"
FILLED = (
    "endereco_principal",
    "endereco_secundario",
    "endereco_alternativo",
    "cidade",
    "estado",
    "site",
)

# Columns that are lowered and trimmed; those that also lose punctuation and accented letters.
TRIMMED = ("tipo_cervejaria", "provincia", "pais", "rua")
STRIPPED = ("nome", "cidade", "estado")

# The derived columns.
VALID_FLAG = "website_url_validacao"
SECURE_FLAG = "indicador_seguranca_site"
FLAG_STRUCT = "validao_site"
FLAG_STRUCT_VALID = "valida_forma"

GOLD_KEYS = ("estado", "tipo_cervejaria")

# Order in which the records were landed: unique, growing. Carried through landing and bronze for keep-first.
LOAD_SEQ = "load_seq"

# Fields of a record that its schema does not name, as a JSON object. A run carries them to silver.
REST = "other_fields"

SOURCE_COLUMNS = tuple(RENAMES)
SILVER_COLUMNS = (*RENAMES.values(), VALID_FLAG, SECURE_FLAG)

# All text: inferring types would turn postal code "01234" into 1234 and break filling nulls with text.
RECORD_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in SOURCE_COLUMNS])
LANDING_SCHEMA = T.StructType([*RECORD_SCHEMA.fields, T.StructField(LOAD_SEQ, T.LongType())])
SILVER_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in RENAMES.values()]
    + [T.StructField(VALID_FLAG, T.BooleanType()), T.StructField(SECURE_FLAG, T.BooleanType())]
)
GOLD_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in GOLD_KEYS] + [T.StructField("count", T.LongType())]
)
