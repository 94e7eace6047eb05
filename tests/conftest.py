import datetime
import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF_DIR = "/root/testdata/sf0.001"

ITEM_SCHEMA = (
    "chave_de_acesso string, codigo_ncm_sh string, data_emissao timestamp_ntz, valor_total decimal(18,2), "
    "cnpj_emitente decimal(18,2), cpf_emitente string, numero long, numero_produto long, "
    "ncm_sh_tipo_de_produto string, descricao_do_produto_servico string, quantidade long"
)
CHAIN_SCHEMA = (
    "codigo_cadeia string, cadeia string, missao string, nome_missao string, prefixo_sh string, "
    "tipo_match string, tamanho_prefixo int, cnae string, desc_cnae string, criterio string, icp string, "
    "missoes string, secao_cnae string, sh_correspondente string"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_items(spark):
    """Item rows with defaults: make_items({"chave_de_acesso": "A", "valor_total": 5}, ...)."""
    default = {
        "chave_de_acesso": "CHAVE001", "codigo_ncm_sh": "88062100", "data_emissao": "2024-06-15",
        "valor_total": 1000, "cnpj_emitente": 11111111000100, "cpf_emitente": None, "numero": 1,
        "numero_produto": 1, "ncm_sh_tipo_de_produto": None, "descricao_do_produto_servico": None, "quantidade": 1,
    }

    def build(*rows):
        filled = []
        for row in rows or ({},):
            full = default | row
            full["data_emissao"] = datetime.datetime.fromisoformat(full["data_emissao"])
            for money in ("valor_total", "cnpj_emitente"):
                full[money] = None if full[money] is None else Decimal(full[money])
            filled.append(tuple(full[name] for name in default))
        return spark.createDataFrame(filled, ITEM_SCHEMA)

    return build


@pytest.fixture
def make_chains(spark):
    """Chain map rows: make_chains(("C1", "8424"), ("C1", "84244", "cnae"))."""
    def build(*rows):
        full = []
        for chain, prefix, *cnae in rows:
            kind = "ncm8" if len(prefix) == 8 else f"prefixo{len(prefix)}"
            full.append((chain, f"Cadeia {chain}", "M1", "Missao 1", prefix, kind, len(prefix), *(cnae or [None]),
                         None, None, None, None, None, None))
        return spark.createDataFrame(full, CHAIN_SCHEMA)

    return build


def column(df, name):
    return [row[name] for row in df.collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
