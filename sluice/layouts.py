"""Layout of the daily-report and registry data: column names, types and rules.

Fixed values: the published file layout and the table columns that loaded data must have.
"""

from __future__ import annotations

from sluice.operators.quality import Rule

# Columns every daily-report file must bring, in file order.
REPORT_RULES = (
    Rule("TP_FUNDO"),
    Rule("CNPJ_FUNDO"),
    Rule("DT_COMPTC"),
    Rule("VL_TOTAL", nullable=True),
    Rule("VL_QUOTA"),
    Rule("VL_PATRIM_LIQ"),
    Rule("CAPTC_DIA"),
    Rule("RESG_DIA"),
    Rule("NR_COTST", kind="bigint"),
)
REPORT_COLUMNS = tuple(rule.column for rule in REPORT_RULES)

# Newer files use these names, and bring one column older files lack.
REPORT_RENAMES = {"TP_FUNDO_CLASSE": "TP_FUNDO", "CNPJ_FUNDO_CLASSE": "CNPJ_FUNDO"}
OPTIONAL_COLUMNS = ("ID_SUBCLASSE",)

AMOUNT_COLUMNS = ("VL_TOTAL", "VL_QUOTA", "VL_PATRIM_LIQ", "CAPTC_DIA", "RESG_DIA")
SILVER_KEYS = ("CNPJ_FUNDO", "TP_FUNDO", "DT_COMPTC")
FILE_VERSION = ("arquivo", "data_modificacao")
MEMBER_VERSION = ("nome_arquivo", "data_modificacao")

BRONZE_COLUMNS = (
    "TP_FUNDO STRING, CNPJ_FUNDO STRING, DT_COMPTC STRING, VL_TOTAL STRING, VL_QUOTA STRING, "
    "VL_PATRIM_LIQ STRING, CAPTC_DIA STRING, RESG_DIA STRING, NR_COTST BIGINT, arquivo STRING, "
    "data_modificacao TIMESTAMP, ano INT, mes INT, ID_SUBCLASSE STRING"
)
SILVER_COLUMNS = (
    "TP_FUNDO STRING, CNPJ_FUNDO STRING, DT_COMPTC DATE, VL_TOTAL DECIMAL(18,2), VL_QUOTA DECIMAL(18,2), "
    "VL_PATRIM_LIQ DECIMAL(18,2), CAPTC_DIA DECIMAL(18,2), RESG_DIA DECIMAL(18,2), DATA_MODIFICACAO TIMESTAMP"
)
CONTROL_COLUMNS = (
    "nome_arquivo STRING, data_modificacao TIMESTAMP, origem_zip STRING, tamanho_bytes BIGINT, "
    "arquivo_ingestao STRING, fonte STRING, situacao_arquivo STRING"
)
FAILURE_COLUMNS = (
    "origem_zip STRING, arquivo STRING, data_modificacao TIMESTAMP, row_id BIGINT, column_name STRING, "
    "check_name STRING, failure_case STRING"
)
MEMBER_CONTENT_COLUMNS = (
    "arquivo_ingestao STRING, origem_zip STRING, nome_arquivo STRING, data_modificacao TIMESTAMP, "
    "chunk_no BIGINT, content BINARY, caminho_destino STRING, problema STRING"
)
# One row per member and version that a load has dealt with, and one without a name per archive it has listed.
RECORD_COLUMNS = (
    "origem_zip STRING, arquivo STRING, data_modificacao TIMESTAMP, estado STRING, linhas BIGINT, falhas BIGINT, "
    "meses ARRAY<STRUCT<ano: INT, mes: INT>>"
)

# Cell texts that count as missing, the defaults of the CSV reader the source files were made for.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
