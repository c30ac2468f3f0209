"""Business rules as Column builders. Everything here stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values: (substring, canonical label) pairs, tested top to bottom, and the fallback label.
RESERVATION_STATUS = (
    ("cancel", "cancelada"), ("confirm", "confirmada"), ("espera", "espera"), ("wait", "espera"),
    ("ativa", "ativa"),
)
RESERVATION_STATUS_OTHER = "desconhecida"
VEHICLE_STATUS = (
    ("alug", "alugado"), ("locad", "alugado"), ("manut", "manutencao"), ("indisp", "indisponivel"),
    ("dispon", "disponivel"), ("avail", "disponivel"),
)
VEHICLE_STATUS_OTHER = "desconhecido"
BILLING_STATUS = (
    ("pend", "pendente"), ("atras", "em_atraso"), ("cancel", "cancelada"), ("pag", "pago"),
    ("quit", "pago"),
)
BILLING_STATUS_OTHER = "desconhecido"
NO_PLATE = "SEMPLACA"
UNKNOWN_COMPANY = "EMPRESA_ND"

MONEY = "decimal(10,2)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_label(text, table, other: str) -> Column:
    """Label of the first table entry whose substring occurs in the lower-cased text."""
    low = F.lower(_col(text))
    labels = [F.when(low.contains(part), label) for part, label in table]
    return F.coalesce(*labels, F.lit(other))


def reservation_status(text) -> Column:
    return first_label(text, RESERVATION_STATUS, RESERVATION_STATUS_OTHER)


def vehicle_status(text) -> Column:
    return first_label(text, VEHICLE_STATUS, VEHICLE_STATUS_OTHER)


def billing_status(text) -> Column:
    return first_label(text, BILLING_STATUS, BILLING_STATUS_OTHER)


def client_type(text) -> Column:
    """PJ only when the trimmed text says so; anything else, NULL included, is PF."""
    return F.when(F.upper(F.trim(_col(text))) == "PJ", "PJ").otherwise("PF")


def transmission(text) -> Column:
    return first_label(text, (("auto", "automatico"),), "manual")


def alnum_or_null(text) -> Column:
    """Upper-case letters and digits of the text; NULL when none remain."""
    kept = F.regexp_replace(F.upper(_col(text)), "[^A-Z0-9]+", "")
    return F.nullif(kept, F.lit(""))


def plate(text) -> Column:
    return F.coalesce(alnum_or_null(text), F.lit(NO_PLATE))


def plate_is_imputed(text) -> Column:
    return alnum_or_null(text).isNull()


def _clamped(left: Column, right: Column, difference: Column) -> Column:
    # greatest() skips NULLs, so the NULL guard has to be explicit.
    return F.when(left.isNotNull() & right.isNotNull(), F.greatest(difference, F.lit(0)))


def days_inclusive(start, end) -> Column:
    """Days from start to end, both counted; 0 when inverted; NULL when a date is missing."""
    a, b = _col(start), _col(end)
    return _clamped(a, b, F.datediff(b, a) + 1)


def days_late(actual, planned) -> Column:
    a, p = _col(actual), _col(planned)
    return _clamped(a, p, F.datediff(a, p))


def km_driven(km_out, km_in) -> Column:
    a, b = _col(km_out), _col(km_in)
    return _clamped(a, b, b - a)


def nonzero(amount) -> Column:
    return F.nullif(_col(amount), F.lit(0))


def late_fee(charged, actual, planned, daily_rate) -> Column:
    """The fee the source charged, else days late times the group's daily rate. Never NULL."""
    days = F.coalesce(days_late(actual, planned), F.lit(0))
    estimate = days * F.coalesce(_col(daily_rate), F.lit(0).cast(MONEY))
    return F.coalesce(nonzero(charged), estimate).cast(MONEY)


def late_fee_is_estimated(charged) -> Column:
    return nonzero(charged).isNull()


def blank_to_null(text) -> Column:
    return F.nullif(F.trim(_col(text)), F.lit(""))


def or_sentinel(text, sentinel: str) -> Column:
    return F.coalesce(blank_to_null(text), F.lit(sentinel))


def digits_only(text) -> Column:
    return F.nullif(F.regexp_replace(_col(text), "[^0-9]+", ""), F.lit(""))


def slug(text) -> Column:
    """Upper-case key in which every run of other characters becomes one underscore."""
    return F.regexp_replace(F.upper(_col(text)), "[^A-Z0-9]+", "_")


def natural_key(source, src_id) -> Column:
    """``source-id``; NULL when the id is NULL (concat propagates, concat_ws would not)."""
    return F.concat(_col(source).cast("string"), F.lit("-"), _col(src_id).cast("string"))


def company_key(source, company_id, company_name) -> Column:
    """Key from the company id when there is one, else from the slug of its name."""
    local = F.coalesce(_col(company_id).cast("string"),
                       slug(or_sentinel(company_name, UNKNOWN_COMPANY)))
    return natural_key(source, local)


def company_label(source, company_name) -> Column:
    return F.coalesce(blank_to_null(company_name),
                      F.concat(F.lit("Empresa G"), _col(source).cast("string")))


def charged_amount(final_price, total, closing, late, repairs) -> Column:
    """First non-zero amount, in order of how complete it is; 0 when there is none.

    A NULL late fee hides the repair fee: the sum of both is then NULL.
    """
    fees = _col(late) + F.coalesce(_col(repairs), F.lit(0).cast(MONEY))
    return F.coalesce(nonzero(final_price), nonzero(total), nonzero(closing), nonzero(fees),
                      F.lit(0).cast(MONEY)).cast(MONEY)


def rental_status(raw, picked_up, returned) -> Column:
    out, back, text = _col(picked_up), _col(returned), F.lower(F.trim(_col(raw)))
    return (F.when(text.contains("cancel"), "cancelada")
            .when(back.isNotNull(), "finalizada")
            .when(out.isNotNull(), "aberta")
            .otherwise(F.coalesce(F.nullif(text, F.lit("")), F.lit("registrada"))))


def date_key(date) -> Column:
    """yyyymmdd as an integer; NULL-safe."""
    d = _col(date)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def lead_days(booked, start) -> Column:
    """Days between booking and start; 0 when one is unknown; may be negative."""
    return F.coalesce(F.datediff(_col(start), _col(booked)), F.lit(0))


def planned_days(start, end) -> Column:
    """Exclusive and not clamped, unlike :func:`days_inclusive`."""
    return F.datediff(_col(end), _col(start))


def days_until_due(returned, due, as_of) -> Column:
    """Days left on an open rental, relative to the run's reference date."""
    return F.when(_col(returned).isNull(), F.datediff(_col(due), F.lit(as_of).cast("date")))


def vehicle_label(plate_col, brand, model) -> Column:
    """``plate - brand model``; a missing part counts as empty."""
    parts = [F.coalesce(_col(c), F.lit("")) for c in (plate_col, brand, model)]
    return F.concat(parts[0], F.lit(" - "), parts[1], F.lit(" "), parts[2])


def percent(part, whole, scale: int) -> Column:
    """100 * part / whole in exact decimal arithmetic; NULL when the whole is 0."""
    den = F.nullif(_col(whole).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(_col(part).cast("decimal(20,0)") * F.lit(100) / den, scale)


def register_sql(spark) -> None:
    """Expose the rules to Spark SQL under their warehouse names, as inlined SQL functions."""
    text = "CASE {} ELSE '{}' END"

    def chain(table, other):
        tests = " ".join(f"WHEN contains(lower(x), '{p}') THEN '{label}'" for p, label in table)
        return text.format(tests, other)

    kept = "nullif(regexp_replace(upper(x), '[^A-Z0-9]+', ''), '')"
    bodies = {
        "fn_normaliza_status_reserva(x STRING) RETURNS STRING":
            chain(RESERVATION_STATUS, RESERVATION_STATUS_OTHER),
        "fn_normaliza_status_veiculo(x STRING) RETURNS STRING":
            chain(VEHICLE_STATUS, VEHICLE_STATUS_OTHER),
        "fn_normaliza_status_cobranca(x STRING) RETURNS STRING":
            chain(BILLING_STATUS, BILLING_STATUS_OTHER),
        "fn_normaliza_tipo_cliente(x STRING) RETURNS STRING":
            "if(coalesce(upper(trim(x)) = 'PJ', false), 'PJ', 'PF')",
        "fn_normaliza_tipo_mecanizacao(x STRING) RETURNS STRING":
            chain((("auto", "automatico"),), "manual"),
        "fn_normaliza_placa(x STRING) RETURNS STRING": f"coalesce({kept}, '{NO_PLATE}')",
        "fn_placa_imputada(x STRING) RETURNS BOOLEAN": f"{kept} IS NULL",
        "fn_dias_inclusivo(a DATE, b DATE) RETURNS INT":
            "if(a IS NULL OR b IS NULL, NULL, greatest(datediff(b, a) + 1, 0))",
        "fn_dias_atraso(a DATE, b DATE) RETURNS INT":
            "if(a IS NULL OR b IS NULL, NULL, greatest(datediff(a, b), 0))",
        "fn_km_rodado(a INT, b INT) RETURNS INT":
            "if(a IS NULL OR b IS NULL, NULL, greatest(b - a, 0))",
        "fn_multa_atraso(v DECIMAL(10,2), a DATE, b DATE, d DECIMAL(10,2)) RETURNS DECIMAL(10,2)":
            "CAST(coalesce(nullif(v, 0), greatest(coalesce(datediff(a, b), 0), 0) * coalesce(d, 0)) "
            "AS DECIMAL(10,2))",
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
