"""Registry datasets (S3): file kind -> table, positional columns and conflict key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Dataset:
    kind: str
    table: str
    columns: tuple[str, ...]
    key: str

    @property
    def raw_schema(self) -> T.StructType:
        """Release files carry text only; the columns are positional."""
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    @property
    def is_lookup(self) -> bool:
        return self.key == "codigo"


# Column order of the release files.
_COMPANY = (
    "cnpj_basico", "razao_social", "natureza_juridica", "qualificacao_responsavel",
    "capital_social", "porte", "ente_federativo_responsavel",
)
_BRANCH = (
    "cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial", "nome_fantasia",
    "situacao_cadastral", "data_situacao_cadastral", "motivo_situacao_cadastral",
    "nome_cidade_exterior", "pais", "data_inicio_atividade", "cnae_fiscal_principal",
    "cnaes_fiscais_secundarios", "tipo_logradouro", "logradouro", "numero", "complemento",
    "bairro", "cep", "uf", "municipio", "ddd1", "telefone1", "ddd2", "telefone2", "ddd_fax",
    "fax", "correio_eletronico", "situacao_especial", "data_situacao_especial",
)
_PARTNER = (
    "cnpj_basico", "identificador_socio", "nome_socio_razao_social", "cpf_cnpj_socio",
    "qualificacao_socio", "data_entrada_sociedade", "pais", "representante_legal",
    "nome_representante", "qualificacao_representante", "faixa_etaria",
)
_SIMPLES = (
    "cnpj_basico", "opcao_simples", "data_opcao_simples", "data_exclusao_simples", "opcao_mei",
    "data_opcao_mei", "data_exclusao_mei",
)
_LOOKUP = (
    "codigo", "descricao",
)

# Order matters: a file belongs to the first kind whose name it contains.
DATASETS: dict[str, Dataset] = {
    kind: Dataset(kind, table, columns, key)
    for kind, table, columns, key in (
        ("Empresas", "empresas", _COMPANY, "cnpj_basico"),
        ("Estabelecimentos", "estabelecimentos", _BRANCH, "cnpj"),
        ("Socios", "socios", _PARTNER, "id"),
        ("Simples", "simples", _SIMPLES, "cnpj_basico"),
        ("Cnaes", "cnaes", _LOOKUP, "codigo"),
        ("Municipios", "municipios", _LOOKUP, "codigo"),
        ("Paises", "paises", _LOOKUP, "codigo"),
        ("Naturezas", "naturezas_juridicas", _LOOKUP, "codigo"),
        ("Qualificacoes", "qualificacoes_socios", _LOOKUP, "codigo"),
        ("Motivos", "motivos_situacao", _LOOKUP, "codigo"),
    )
}

# Columns that hold a yyyymmdd date.
DATE_COLUMNS = frozenset((
    "data_situacao_cadastral", "data_inicio_atividade", "data_situacao_especial",
    "data_entrada_sociedade", "data_opcao_simples", "data_exclusao_simples", "data_opcao_mei",
    "data_exclusao_mei",
))

# Amount columns, stored as DECIMAL(18,2).
AMOUNT_COLUMNS = frozenset({"capital_social"})
