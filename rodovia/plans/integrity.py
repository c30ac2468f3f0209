"""Operational-schema rules as batch audits: domains, checks, uniqueness, references, deletes."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rodovia.plans.conform import unpivot_counts
from rodovia.plans.quality import reference_audit, stack
from rodovia.sources.extract import duplicate_keys

Tables = Mapping[str, DataFrame]

# The operational schema's closed lists.
DOMAINS = {
    ("cliente", "tipo"): ("PF", "PJ"),
    ("veiculo", "tipo_mecanizacao"): ("manual", "automatico"),
    ("veiculo", "status"): ("disponivel", "alugado", "manutencao"),
    ("vaga", "status"): ("livre", "ocupada"),
    ("reserva", "status"): ("ativa", "confirmada", "cancelada", "espera"),
    ("cobranca", "status"): ("pendente", "pago", "cancelado"),
}

UNIQUE = {
    "empresa_locadora": ["cnpj"], "condutor": ["cnh"], "veiculo": ["placa", "chassi"],
    "acessorio": ["nome"], "locacao": ["reserva_id"], "cobranca": ["locacao_id"],
}

CASCADE, RESTRICT, SET_NULL = "CASCADE", "RESTRICT", "SET NULL"


@dataclass(frozen=True)
class Reference:
    child: str
    column: str
    parent: str
    on_delete: str
    key: str = "id"


REFERENCES = [
    Reference("condutor", "cliente_id", "cliente", RESTRICT),
    Reference("veiculo", "grupo_id", "grupo_veiculo", RESTRICT),
    Reference("veiculo", "empresa_id", "empresa_locadora", RESTRICT),
    Reference("veiculo_acessorio", "veiculo_id", "veiculo", CASCADE),
    Reference("veiculo_acessorio", "acessorio_id", "acessorio", CASCADE),
    Reference("vaga", "patio_id", "patio", CASCADE),
    Reference("reserva", "cliente_id", "cliente", RESTRICT),
    Reference("reserva", "grupo_id", "grupo_veiculo", RESTRICT),
    Reference("reserva", "patio_retirada_id", "patio", RESTRICT),
    Reference("reserva", "patio_devolucao_id", "patio", RESTRICT),
    Reference("locacao", "reserva_id", "reserva", SET_NULL),
    Reference("locacao", "veiculo_id", "veiculo", RESTRICT),
    Reference("locacao", "condutor_id", "condutor", RESTRICT),
    Reference("locacao", "patio_retirada_id", "patio", RESTRICT),
    Reference("locacao", "patio_devolucao_id", "patio", RESTRICT),
    Reference("cobranca", "locacao_id", "locacao", SET_NULL),
    Reference("locacao_seguro", "locacao_id", "locacao", CASCADE),
    Reference("locacao_seguro", "seguro_id", "seguro", RESTRICT),
    Reference("foto", "veiculo_id", "veiculo", CASCADE),
    Reference("manutencao", "veiculo_id", "veiculo", CASCADE),
    Reference("movimentacao_patio", "veiculo_id", "veiculo", RESTRICT),
    Reference("movimentacao_patio", "origem_patio_id", "patio", RESTRICT),
    Reference("movimentacao_patio", "destino_patio_id", "patio", RESTRICT),
]


def _c(name: str) -> Column:
    return F.col(name)


def temporal_rules() -> dict[tuple[str, str], Column]:
    """Violation predicates; a NULL comparison is no violation, as with CHECK."""
    picked, returned = _c("data_retirada_realizada"), _c("data_devolucao_realizada")
    return {
        ("reserva", "fim_antes_do_inicio"): _c("data_fim") < _c("data_inicio"),
        ("locacao", "devolucao_prevista_antes_da_retirada"):
            _c("data_devolucao_prevista") < _c("data_retirada_prevista"),
        ("locacao", "devolucao_sem_retirada_ou_anterior"):
            returned.isNotNull() & (picked.isNull() | (returned < picked)),
    }


def odometer_rules() -> dict[tuple[str, str], Column]:
    def wrong(event: str, km: str) -> Column:
        return _c(event).isNotNull() & (_c(km).isNull() | (_c(km) < 0))
    return {
        ("locacao", "retirada_sem_km"): wrong("data_retirada_realizada", "km_entrega"),
        ("locacao", "devolucao_sem_km"): wrong("data_devolucao_realizada", "km_devolucao"),
    }


def value_rules() -> dict[tuple[str, str], Column]:
    return {
        ("cobranca", "valor_negativo"): _c("valor") < 0,
        ("seguro", "valor_negativo"): _c("valor") < 0,
        ("movimentacao_patio", "origem_igual_destino"):
            _c("origem_patio_id") == _c("destino_patio_id"),
    }


def domain_rules() -> dict[tuple[str, str], Column]:
    return {(t, f"{c}_fora_do_dominio"): ~_c(c).isin(*allowed) for (t, c), allowed in DOMAINS.items()}


def audit(oltp: Tables, rules: Mapping[tuple[str, str], Column]) -> DataFrame:
    """(tabela, regra, violacoes); all rules of a table share one scan."""
    by_table: dict[str, list[tuple[str, Column]]] = {}
    for (table, rule), bad in rules.items():
        by_table.setdefault(table, []).append((rule, bad))
    return stack(
        unpivot_counts(oltp[t].agg(*[F.count_if(bad).alias(rule) for rule, bad in checks]),
                       "regra", "violacoes")
        .select(F.lit(t).alias("tabela"), "regra", "violacoes")
        for t, checks in by_table.items())


def violations(oltp: Tables, table: str, bad: Column) -> DataFrame:
    """The offending rows of one rule."""
    return oltp[table].filter(bad)


def uniqueness(oltp: Tables) -> DataFrame:
    """(tabela, coluna, chaves, linhas) of non-null values that occur more than once."""
    zero = F.lit(0).cast("bigint")
    return stack(
        duplicate_keys(oltp[t].filter(_c(c).isNotNull()), [c])
        .agg(F.count("*").alias("chaves"), F.coalesce(F.sum("ocorrencias"), zero).alias("linhas"))
        .select(F.lit(t).alias("tabela"), F.lit(c).alias("coluna"), "chaves", "linhas")
        for t, columns in UNIQUE.items() for c in columns)


def foreign_keys(oltp: Tables) -> DataFrame:
    """(tabela, coluna, pai, orfaos) for every reference; every table is read once."""
    return reference_audit(oltp, [(r.child, r.column, r.parent, r.key) for r in REFERENCES]).drop("nulos")


def _impact(oltp: Tables, table: str, doomed: DataFrame, seen: tuple[str, ...]):
    for r in REFERENCES:
        if r.parent != table or r.child in seen:
            continue
        keys = doomed.select(_c(r.key).alias(r.column))
        hit = oltp[r.child].join(keys, r.column, "left_semi")
        yield r, hit
        if r.on_delete == CASCADE and any(x.parent == r.child for x in REFERENCES):
            yield from _impact(oltp, r.child, hit, (*seen, r.child))


def delete_impact(oltp: Tables, table: str, doomed: DataFrame) -> DataFrame:
    """What deleting the rows ``doomed`` of ``table`` would do.

    One row per reference: rows removed with them (CASCADE, followed transitively), rows that
    forbid the delete (RESTRICT) and rows whose reference is cleared (SET NULL).
    """
    return stack(
        hit.agg(F.count("*").alias("linhas")).select(
            F.lit(r.child).alias("tabela"), F.lit(r.column).alias("coluna"),
            F.lit(r.on_delete).alias("acao"), "linhas")
        for r, hit in _impact(oltp, table, doomed, (table,)))


def deletable(oltp: Tables, table: str, doomed: DataFrame) -> bool:
    """True when no RESTRICT reference stands in the way."""
    blocked = delete_impact(oltp, table, doomed).filter("acao = 'RESTRICT' AND linhas > 0")
    return blocked.isEmpty()
