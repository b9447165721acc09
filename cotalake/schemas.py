"""Column aliases, rule values and table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Accepted source names per standard column, in order of preference.
CLASS_CNPJ = ["CNPJ_FUNDO_CLASSE", "cnpj_fundo_classe", "CNPJ_Classe", "cnpj_classe", "CNPJ_Fundo_Classe"]
CLASS_CNPJ_CLOUD = ["CNPJ_FUNDO_CLASSE", "cnpj_fundo_classe", "CNPJ_Classe"]
CLASS_NAME = ["DENOM_SOCIAL", "denom_social", "Denominacao_Social", "denominacao_social", "nome", "Nome"]
CLASS_NAME_CLOUD = ["DENOM_SOCIAL", "denom_social", "Denominacao_Social", "nome"]
CLASS_OPTIONAL = [
    ["Tipo_Classe", "TIPO_FUNDO", "tipo_fundo"],
    ["Classificacao", "CLASSIFICACAO", "classificacao"],
    ["Situacao", "SITUACAO", "situacao"],
    ["Publico_Alvo", "PUBLICO_ALVO", "publico_alvo"],
]
REPORT_CNPJ = ["CNPJ_FUNDO_CLASSE", "cnpj_fundo_classe"]
REPORT_CNPJ_CLOUD = ["CNPJ_FUNDO_CLASSE", "cnpj_fundo_classe", "CNPJ_Classe"]
REPORT_DATE = ["DT_COMPTC", "dt_comptc", "data"]
REPORT_EQUITY = ["VL_PATRIM_LIQ", "vl_patrim_liq", "patrimonio"]
REPORT_HOLDERS = ["NR_COTST", "nr_cotst", "cotistas"]
REPORT_INFLOW = ["CAPTC_DIA", "captc_dia", "captacao"]
REPORT_REDEMPTION = ["RESG_DIA", "resg_dia", "resgate"]

# The numeric columns of the daily report.
REPORT_NUMERIC = ["VL_TOTAL", "VL_QUOTA", "VL_PATRIM_LIQ", "CAPTC_DIA", "RESG_DIA", "NR_COTST"]

# Registry rules. None means "must be present".
FUND_RULES = {
    "Data_Adaptacao_RCVM175": None,
    "Tipo_Fundo": ["FIP", "FIF", "FACFIF", "FI"],
    "Situacao": ["Em Funcionamento Normal"],
    "Forma_Condominio": ["Aberto"],
    "Exclusivo": ["N"],
}
CLASS_RULES = {
    "Forma_Condominio": ["Aberto"],
    "Classificacao": ["Renda Fixa", "Ações", "Multimercado"],
    "Exclusivo": ["N"],
    "Situacao": ["Em Funcionamento Normal"],
}
SUBCLASS_RULES = {
    "Forma_Condominio": ["Aberto"],
    "Exclusivo": ["N"],
    "Exclusivo_INR": ["N"],
    "Situacao": ["Em Funcionamento Normal"],
}

# Texts a delimited reader takes as missing.
NA_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

PERIODS = [7, 30, 60, 90]

_TYPES: dict[str, T.DataType] = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "decimal(19,2)": T.DecimalType(19, 2),
    "decimal(17,3)": T.DecimalType(17, 3),
}


def columns(spec: str) -> T.StructType:
    """``name type, name type`` to a schema; unlike ``fromDDL`` it needs no running session."""
    pairs = [item.split(" ") for item in spec.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


MOVEMENT = columns(
    "fk_cliente bigint, fk_classe bigint, fk_subclasse bigint, natureza_operacao string, "
    "valor decimal(19,2), data timestamp"
)

_OPERATIONAL = {
    "segmento": "id_segmento int, nome string",
    "cliente": (
        "id_cliente bigint, fk_segmento int, cpf_cnpj string, nome string, perfil_risco string, "
        "tipo_investidor string, data_cadastro timestamp"
    ),
    "gerente": "id_gerente bigint, fk_segmento int, nome string, email string",
    "cliente_gerente": (
        "id_cliente_gerente bigint, cliente_id_cliente bigint, gerente_id_gerente bigint, "
        "data_inicio timestamp, data_fim timestamp"
    ),
    "fundo": (
        "id_registro_fundo bigint, cnpj string, denominacao_social string, gestor string, cnpj_gestor string, "
        "administrador string, cnpj_administrador string, tipo_fundo string, data_constituicao date, "
        "data_registro date, codigo_cvm int, data_cancelamento date, situacao string, "
        "data_inicio_situacao date, is_proprio string"
    ),
    "gestor_fundo": "id_gestor_fundo bigint, nome string, email string",
    "usuario": "id_usuario bigint, fk_gerente bigint, fk_gestor_fundo bigint, email string, is_adm string",
    "classe": (
        "id_registro_classe bigint, fk_registro_fundo bigint, cnpj string, id_registro_fundo bigint, "
        "tipo_classe string, denominacao_social string, classificacao string, auditor string, "
        "custodiante string, controlador string, classificacao_anbima string, indicador_desempenho string, "
        "is_proprio string"
    ),
    "subclasse": (
        "id_subclasse bigint, id_registro_classe bigint, codigo_cvm int, denominacao_social string, "
        "situacao string, publico_alvo string, previdenciario string, is_proprio string"
    ),
    "informe_diario": (
        "id_patrimonio_liquido bigint, data_competencia date, fk_subclasse bigint, fk_registro_classe bigint, "
        "fundo_id_registro_fundo bigint, valor_patrimonio_liquido decimal(19,2), quantidade_cotista bigint, "
        "valor_cota decimal(19,2), captacao decimal(19,2), resgate decimal(19,2), data_insercao timestamp, "
        "data_modificacao timestamp"
    ),
    "fundo_cotista": (
        "id_fundo_cotista bigint, fk_registro_classe bigint, fk_subclasse bigint, fk_cliente bigint, "
        "data_inicio date, quantidade_cotas decimal(17,3)"
    ),
    "parametro_alerta": (
        "id_parametro_alerta bigint, fk_registro_classe bigint, fk_subclasse bigint, nome string, valor string"
    ),
    "aplicacao_resgate": (
        "id_aplicacao_resgate bigint, fk_cliente bigint, fk_classe bigint, fk_subclasse bigint, "
        "natureza_operacao string, valor decimal(19,2), data timestamp"
    ),
}

OPERATIONAL_TABLES: dict[str, T.StructType] = {name: columns(spec) for name, spec in _OPERATIONAL.items()}
