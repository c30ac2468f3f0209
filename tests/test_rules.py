"""Every rule on its valid and boundary inputs, as Column builders and as SQL functions."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rodovia.functions import rules as R

DAY = {n: dt.date(2026, 5, n) for n in range(1, 32)}
D = Decimal

CASES = [
    (R.reservation_status, ["CANCELADO"], "cancelada"), (R.reservation_status, ["estado_invalido"], "desconhecida"),
    (R.reservation_status, [None], "desconhecida"), (R.reservation_status, ["Confirmed"], "confirmada"),
    (R.reservation_status, ["in waiting"], "espera"), (R.reservation_status, ["em ESPERA"], "espera"),
    (R.reservation_status, ["inativa"], "ativa"), (R.reservation_status, ["cancelada ativa"], "cancelada"),
    (R.vehicle_status, ["Locado"], "alugado"), (R.vehicle_status, ["status_zoado"], "desconhecido"),
    (R.vehicle_status, ["Indisponivel"], "indisponivel"), (R.vehicle_status, ["available"], "disponivel"),
    (R.vehicle_status, [None], "desconhecido"), (R.vehicle_status, ["em manutencao"], "manutencao"),
    (R.billing_status, ["QUITADO"], "pago"), (R.billing_status, ["pendente"], "pendente"),
    (R.billing_status, ["estornado"], "desconhecido"), (R.billing_status, [None], "desconhecido"),
    (R.billing_status, ["nao pago"], "pago"), (R.billing_status, ["Em Atraso"], "em_atraso"),
    (R.client_type, ["pj"], "PJ"), (R.client_type, [" PJ "], "PJ"), (R.client_type, ["xyz"], "PF"),
    (R.client_type, [None], "PF"),
    (R.transmission, ["Cambio Automatico"], "automatico"), (R.transmission, ["cvt?"], "manual"),
    (R.transmission, [None], "manual"),
    (R.plate, ["abc-1d23"], "ABC1D23"), (R.plate, [None], "SEMPLACA"), (R.plate, [" -- "], "SEMPLACA"),
    (R.plate_is_imputed, [None], True), (R.plate_is_imputed, ["ABC1D23"], False),
    (R.days_inclusive, [DAY[1], DAY[1]], 1), (R.days_inclusive, [DAY[1], DAY[5]], 5),
    (R.days_inclusive, [DAY[5], DAY[1]], 0), (R.days_inclusive, [None, DAY[1]], None),
    (R.days_late, [DAY[5], DAY[3]], 2), (R.days_late, [DAY[1], DAY[3]], 0), (R.days_late, [None, DAY[3]], None),
    (R.km_driven, [10000, 10350], 350), (R.km_driven, [5000, 4000], 0), (R.km_driven, [5000, None], None),
    (R.late_fee, [D("150.00"), DAY[5], DAY[3], D("100.00")], D("150.00")),
    (R.late_fee, [None, DAY[5], DAY[3], D("100.00")], D("200.00")),
    (R.late_fee, [D("0.00"), DAY[5], DAY[3], D("100.00")], D("200.00")),
    (R.late_fee, [None, DAY[1], DAY[3], D("100.00")], D("0.00")),
    (R.late_fee, [None, None, DAY[3], D("100.00")], D("0.00")),
    (R.late_fee, [None, DAY[5], DAY[3], None], D("0.00")),
    (R.late_fee_is_estimated, [D("0.00")], True), (R.late_fee_is_estimated, [D("1.00")], False),
    (R.blank_to_null, ["  "], None), (R.digits_only, ["(21) 9-9"], "2199"), (R.digits_only, ["--"], None),
    (R.digits_only, [None], None), (R.slug, ["Frota & Cia"], "FROTA_CIA"),
    (R.natural_key, [4, 12], "4-12"), (R.natural_key, [4, None], None),
    (R.company_key, [3, 9, "x"], "3-9"), (R.company_key, [3, None, " Frota & Cia "], "3-FROTA_CIA"),
    (R.company_key, [4, None, None], "4-EMPRESA_ND"), (R.company_label, [4, " "], "Empresa G4"),
    (R.charged_amount, [D("0"), D("7"), D("8"), None, None], D("7.00")),
    (R.charged_amount, [None, None, None, D("5"), None], D("5.00")),
    (R.charged_amount, [None, None, None, None, D("9")], D("0.00")),
    (R.rental_status, ["Cancelada", DAY[1], DAY[2]], "cancelada"), (R.rental_status, [None, DAY[1], None], "aberta"),
    (R.rental_status, [None, DAY[1], DAY[2]], "finalizada"), (R.rental_status, [" Nova ", None, None], "nova"),
    (R.rental_status, [" ", None, None], "registrada"),
    (R.date_key, [dt.date(2026, 5, 7)], 20260507), (R.date_key, [None], None),
    (R.lead_days, [DAY[9], DAY[5]], -4), (R.lead_days, [None, DAY[5]], 0),
    (R.planned_days, [DAY[5], DAY[1]], -4), (R.planned_days, [DAY[5], None], None),
    (R.vehicle_label, ["P", None, "M"], "P -  M"),
    (R.percent, [1, 3, ], D("33.33")), (R.percent, [1, 0], None),
]

TYPES = {str: "string", int: "int", dt.date: "date", Decimal: "decimal(10,2)", bool: "boolean"}


def arguments(values):
    kinds = [type(v) for v in values]
    default = next((k for k in kinds if k is not type(None)), str)
    return [F.lit(v).cast(TYPES[k if k is not type(None) else default]) for v, k in zip(values, kinds)]


def test_rules(spark):
    row = spark.range(1)
    columns = []
    for i, (rule, values, _) in enumerate(CASES):
        args = arguments(values)
        if rule in (R.charged_amount, R.late_fee):
            args = [F.lit(v).cast("decimal(10,2)") if not isinstance(v, dt.date) and not (
                rule is R.late_fee and k in (1, 2)) else F.lit(v).cast("date") for k, v in enumerate(values)]
        if rule is R.rental_status:
            args = [F.lit(values[0]).cast("string"), *[F.lit(v).cast("date") for v in values[1:]]]
        if rule is R.company_key:
            args = [F.lit(values[0]), F.lit(values[1]).cast("int"), F.lit(values[2]).cast("string")]
        if rule is R.percent:
            args = [*args, 2]
        columns.append(rule(*args).alias(f"c{i}"))
    got = row.select(*columns).first()
    wrong = [(rule.__name__, v, want, got[i]) for i, (rule, v, want) in enumerate(CASES) if got[i] != want]
    assert not wrong


def test_days_until_due(spark):
    row = spark.range(1).select(
        R.days_until_due(F.lit(None).cast("date"), F.lit(DAY[9]), DAY[4]).alias("a"),
        R.days_until_due(F.lit(DAY[1]), F.lit(DAY[9]), DAY[4]).alias("b")).first()
    assert (row.a, row.b) == (5, None)


@pytest.mark.parametrize("call,want", [
    ("fn_normaliza_status_reserva('CANCELADO')", "cancelada"),
    ("fn_normaliza_status_veiculo('Indisponivel')", "indisponivel"),
    ("fn_normaliza_status_cobranca(NULL)", "desconhecido"),
    ("fn_normaliza_tipo_cliente(' pj')", "PJ"), ("fn_normaliza_tipo_mecanizacao(NULL)", "manual"),
    ("fn_normaliza_placa('abc-1d23')", "ABC1D23"), ("fn_placa_imputada(NULL)", True),
    ("fn_dias_inclusivo(DATE'2026-05-01', DATE'2026-05-05')", 5),
    ("fn_dias_atraso(DATE'2026-05-01', DATE'2026-05-03')", 0), ("fn_km_rodado(5000, 4000)", 0),
    ("fn_multa_atraso(NULL, DATE'2026-05-05', DATE'2026-05-03', 100.00)", D("200.00")),
])
def test_sql_functions(spark, call, want):
    R.register_sql(spark)
    assert spark.sql(f"SELECT {call}").first()[0] == want
