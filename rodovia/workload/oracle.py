"""Plain SQL for the same inputs: one common table expression per proxy, conformed table and fact.

Statements are assembled from the expressions they mention. They run on another engine over the raw
tables and share no code with the DataFrame plans, apart from the staging column order that breaks ties.
"""

from __future__ import annotations

import re

from rodovia.schemas import STAGING, column_names

AS_OF = "2001-12-31"
RUN_TS = "2002-03-01 00:00:00"


def half_up(num: str, den: str) -> str:
    """Integer division rounded half up, exact for non-negative operands."""
    return f"((2*({num}) + ({den})) // (2*({den})))"


def cents(x: str) -> str:
    return f"cast(({x})*100 as bigint)"


def has(x: str, part: str) -> str:
    return f"coalesce(contains(lower({x}), '{part}'), false)"


def reserva_st(x: str) -> str:
    return (f"case when {has(x, 'cancel')} then 'cancelada' when {has(x, 'confirm')} then 'confirmada' "
            f"when {has(x, 'espera')} or {has(x, 'wait')} then 'espera' "
            f"when {has(x, 'ativa')} then 'ativa' else 'desconhecida' end")


def veiculo_st(x: str) -> str:
    return (f"case when {has(x, 'alug')} or {has(x, 'locad')} then 'alugado' "
            f"when {has(x, 'manut')} then 'manutencao' when {has(x, 'indisp')} then 'indisponivel' "
            f"when {has(x, 'dispon')} or {has(x, 'avail')} then 'disponivel' else 'desconhecido' end")


def cobranca_st(x: str) -> str:
    return (f"case when {has(x, 'pend')} then 'pendente' when {has(x, 'atras')} then 'em_atraso' "
            f"when {has(x, 'cancel')} then 'cancelada' when {has(x, 'pag')} or {has(x, 'quit')} "
            "then 'pago' else 'desconhecido' end")


def cliente_tp(x: str) -> str:
    return f"if(coalesce(upper(trim({x})), '') = 'PJ', 'PJ', 'PF')"


def placa(x: str) -> str:
    return f"coalesce(nullif(regexp_replace(upper({x}), '[^A-Z0-9]', '', 'g'), ''), 'SEMPLACA')"


def blank(x: str) -> str:
    return f"nullif(trim({x}), '')"


def digits(x: str) -> str:
    return f"nullif(regexp_replace({x}, '[^0-9]', '', 'g'), '')"


def slug(x: str) -> str:
    return f"regexp_replace(upper({x}), '[^A-Z0-9]+', '_', 'g')"


def nk(x: str, g: str = "grupo_fonte") -> str:
    return f"cast({g} as varchar) || '-' || cast({x} as varchar)"


def empresa_nk(company: str, name: str) -> str:
    key = slug(f"coalesce({blank(name)}, 'EMPRESA_ND')")
    return f"cast(grupo_fonte as varchar) || '-' || coalesce(cast({company} as varchar), {key})"


def ymd(d: str) -> str:
    return f"cast(strftime({d}, '%Y%m%d') as int)"


def incl(a: str, b: str) -> str:
    return f"case when {a} is not null and {b} is not null then greatest(date_diff('day', {a}, {b}) + 1, 0) end"


def late(real: str, due: str) -> str:
    return f"case when {real} is not null and {due} is not null then greatest(date_diff('day', {due}, {real}), 0) end"


def latest(name: str) -> str:
    """The newest row per key, ties broken by every other column in schema order."""
    entity = {"s_grupo": "grupo_veiculo", "s_mov": "movimentacao_patio"}.get(name, name[2:])
    rest = [c for c in column_names(STAGING[entity])
            if c not in ("grupo_fonte", "src_id", "dt_extracao")]
    order = ", ".join(["dt_extracao desc", *[f"{c} asc nulls last" for c in rest]])
    return (f"select * from {name} qualify row_number() over "
            f"(partition by grupo_fonte, src_id order by {order}) = 1")


MESES = "['Janeiro','Fevereiro','Março','Abril','Maio','Junho','Julho','Agosto','Setembro','Outubro','Novembro','Dezembro']"
DIAS = "['Segunda-feira','Terça-feira','Quarta-feira','Quinta-feira','Sexta-feira','Sábado','Domingo']"


def calendario(src: str) -> str:
    return (f"select {ymd('data')} sk_tempo, data, year(data) ano, month(data) mes, {MESES}[month(data)] nome_mes, "
            f"quarter(data) trimestre, day(data) dia, isodow(data) dia_semana, {DIAS}[isodow(data)] nome_dia_semana, "
            f"isodow(data) >= 6 flag_fim_de_semana from {src}")


CTE: dict[str, str] = {}

# --- staging proxies ------------------------------------------------------------------------------

CTE["p_fontes"] = "select unnest([1, 2, 3, 4]) g"
CTE["p_tipos"] = f"""select p_type, row_number() over (order by p_type) tid,
  cast({half_up(cents('sum(cast(p_retailprice as decimal(12,2)))'), 'count(*)')} / 100.0 as decimal(10,2)) diaria
  from part group by p_type"""
CTE["s_cliente"] = """select c_custkey src_id,
  case when c_custkey%17=0 then null when c_custkey%19=0 then '  ' else c_name end nome,
  case when c_mktsegment in ('BUILDING','MACHINERY') then ' pj ' else 'pf' end tipo, n_name cidade,
  case c_custkey%5 when 0 then ' rj ' when 1 then '' else 'SP' end uf,
  case when c_custkey%7<>0 then c_name || '@Mail.COM' end email,
  case when c_custkey%11=0 then '--' else '+55 (21) ' || cast(c_custkey+100000 as varchar) end telefone,
  cast(c_custkey%4+1 as int) grupo_fonte, timestamp '2024-01-01' dt_extracao
  from customer join nation on n_nationkey = c_nationkey"""
CTE["s_condutor"] = """select c_custkey src_id, c_custkey src_cliente_id,
  case when c_custkey%13<>0 then 'Condutor ' || cast(c_custkey as varchar) end nome,
  'CNH ' || cast(c_custkey+1000 as varchar) || '-' || cast(c_custkey%10 as varchar) cnh,
  date '2025-01-01' + cast(c_custkey%1000 as int) validade,
  case c_custkey%3 when 0 then ' b ' when 1 then '' else 'ad' end categoria, cast(null as varchar) telefone,
  cast(c_custkey%4+1 as int) grupo_fonte, timestamp '2024-01-01' dt_extracao
  from customer where c_custkey%101<>0"""
CTE["s_grupo"] = """select tid src_id, case when tid=6 then ' ' else p_type end nome,
  case when tid%2=1 then 'Linha ' || p_type end categoria, diaria, g grupo_fonte, timestamp '2024-01-01' dt_extracao
  from p_tipos cross join p_fontes"""
CTE["s_veiculo"] = """select p_partkey src_id,
  case when p_partkey%13<>0 then substr(p_brand,1,5) || '-' || cast(p_partkey as varchar) end placa,
  case when p_partkey%9=0 then ' ' else 'CH' || cast(p_partkey as varchar) end chassi,
  case when p_partkey%37<>0 then p_name end modelo, p_brand marca,
  case when g=1 then split_part(p_name, ' ', 1) end cor,
  case when p_size%3=0 then 'Cambio Automatico' else 'cvt?' end tipo_mecanizacao,
  case when p_size%5<>0 then p_size%2=0 end ar_condicionado, p_size%10=1 adaptado_cadeirante,
  case p_size%7 when 0 then 'Locado' when 1 then 'EM MANUTENCAO' when 2 then 'Indisponivel' when 3 then 'available'
    when 4 then 'status_zoado' when 6 then 'disponivel' end status,
  case when p_partkey%499<>0 then tid end src_grupo_id,
  case when g<>4 and not (g=3 and p_partkey%50=0) then p_partkey%10 end src_empresa_id,
  case when g=4 then null when g=3 and p_partkey%50=0 then ' Frota & Cia ' when p_partkey%10=7 then '  '
    else 'Empresa ' || cast(p_partkey%10 as varchar) end nome_empresa,
  g grupo_fonte, timestamp '2024-01-01' dt_extracao
  from part join p_tipos using (p_type) cross join p_fontes"""
CTE["s_patio"] = """select n_nationkey src_id, case when n_nationkey=0 then ' ' else n_name end nome, r_name cidade,
  case when n_nationkey%6<>0 then n_nationkey%6*20 end capacidade,
  case when g in (2,3) then n_nationkey%3 end src_empresa_id,
  case when g=4 then 'Dona ' || r_name when g=3 then 'Empresa ' || cast(n_nationkey%3 as varchar) end nome_empresa,
  g grupo_fonte, timestamp '2024-01-01' dt_extracao
  from nation join region on r_regionkey = n_regionkey cross join p_fontes"""
CTE["s_vaga"] = """select s_name codigo, s_nationkey src_patio_id,
  case when s_suppkey%3=0 then 'ocupada' else 'livre' end status, g grupo_fonte, timestamp '2024-01-01' dt_extracao
  from supplier cross join p_fontes where g <= 2"""
CTE["s_reserva"] = """select o_orderkey src_id, ck src_cliente_id,
  case when o_orderkey%97=0 then 99 else o_orderkey%6+1 end src_grupo_id, o_orderkey%25 src_patio_retirada_id,
  case when o_orderkey%11<>0 then (o_orderkey*7+3)%25 end src_patio_devolucao_id,
  case when ck%4+1=4 then o_orderdate - interval 3 day end data_solicitacao,
  case when ck%4+1 in (2,3) and o_orderkey%13<>0 then o_orderdate - to_days(cast(o_orderkey%30 as int)) end data_reserva,
  case when o_orderkey%307<>0 then o_orderdate end data_inicio,
  case when o_orderkey%23<>0 then o_orderdate + to_days(cast(o_orderkey%15-2 as int)) end data_fim,
  case when o_orderstatus='F' then 'CONFIRMADO' when o_orderstatus='P' and o_orderpriority like '1%' then 'em espera'
    when o_orderstatus='P' then 'Ativa' when o_orderpriority like '5%' then 'estado_invalido'
    when o_orderpriority not like '4%' then 'Cancelled' end status,
  case when ck%4+1=2 then cast(o_totalprice as decimal(10,2)) end preco_final,
  case when ck%4+1=3 then cast(o_totalprice as decimal(10,2)) end preco_previsto,
  cast(ck%4+1 as int) grupo_fonte, timestamp '2002-01-01' dt_extracao
  from (select *, case when o_custkey>0 and o_custkey%31=0 then o_custkey+1 else o_custkey end ck from orders)"""
CTE["p_linhas"] = """select *, l_orderkey*10+l_linenumber lid, cast(o_custkey%4+1 as int) g,
  not (l_linestatus='O' and l_returnflag='N') and l_orderkey%41<>0 voltou, cast(l_extendedprice as decimal(10,2)) preco
  from lineitem join orders on o_orderkey = l_orderkey"""
CTE["s_locacao"] = """select lid src_id, case when voltou then l_suppkey end src_devolucao_id,
  case when l_linenumber=1 and l_orderkey%5<>0 then l_orderkey end src_reserva_id,
  case when l_partkey>0 and l_partkey%29=0 then l_partkey-1 else l_partkey end src_veiculo_id,
  o_custkey src_condutor_id, case when l_orderkey%401<>0 then o_custkey end src_cliente_id,
  l_orderkey%25 src_patio_retirada_id, case when voltou then l_suppkey%25 end src_patio_devolucao_id,
  case when l_orderkey%83<>0 then o_orderdate end data_retirada_prevista,
  case when l_orderkey%41<>0 and l_orderkey%83<>0 then o_orderdate + to_days(l_linenumber%3) + interval 9 hour end data_retirada_realizada,
  o_orderdate + interval 7 day data_devolucao_prevista,
  case when voltou then o_orderdate + to_days(cast(l_quantity as int)%15) + interval 18 hour end data_devolucao_realizada,
  cast(l_partkey*10 as int) km_entrega,
  case when voltou then cast(l_partkey*10 + l_quantity*20 - 100 as int) end km_devolucao,
  cast(l_suppkey%9 as int) gasolina_entrega, case when voltou then cast(l_partkey%9 as int) end gasolina_devolucao,
  case when l_returnflag='R' then cast(l_discount*1000 as decimal(10,2)) end valor_atraso,
  case when l_linenumber%2=0 then cast(l_tax*100 as decimal(10,2)) end valor_reparos,
  case when g=2 and l_linenumber<>5 then preco when g=2 then 0 end preco_final,
  case when g=3 or l_linenumber=5 then preco end valor_total, case when g=4 then preco end valor_final,
  case when l_orderkey%29=0 then 'Cancelada pelo cliente' when l_orderkey%41=0 and l_linenumber%2=0 then ' Pre-Reservada ' end status,
  'ok' estado_entrega, cast(null as varchar) estado_devolucao,
  case when l_linenumber%4<>0 then o_orderdate + interval 8 hour end created_at, cast(null as timestamp) updated_at,
  g grupo_fonte, l_shipdate dt_extracao from p_linhas"""
CTE["s_cobranca"] = """select lid src_id, case when l_orderkey%211=0 then l_orderkey*10+8 else lid end src_locacao_id,
  case when not (l_linenumber=6 and l_suppkey%5=0) then preco end valor,
  case l_returnflag||l_linestatus when 'AF' then 'PAGO' when 'AO' then 'quitado' when 'RF' then 'Pago'
    when 'RO' then 'cancelada' when 'NF' then 'em atraso' else 'pendente' end status,
  cast(l_shipdate as date) data_pagamento, g grupo_fonte, l_shipdate dt_extracao from p_linhas"""
CTE["s_mov"] = """select event_id src_id, case when event_id%997<>0 then user_id end src_veiculo_id,
  user_id%25 src_origem_id, (event_id*7+3)%25 src_destino_id, ts data_movimentacao,
  case when event_id%3=0 then '  ' else event_type end motivo, cast(user_id%4+1 as int) grupo_fonte,
  timestamp '2024-02-01' dt_extracao
  from events where user_id%25 <> (event_id*7+3)%25"""

# --- conformed ------------------------------------------------------------------------------------

CTE["k_cliente"] = f"""select {nk('src_id')} cliente_nk, src_id, grupo_fonte,
  coalesce({blank('nome')}, 'Cliente nao informado') nome, {blank('nome')} is null flag_nome_imputado,
  {cliente_tp('tipo')} tipo, {blank('cidade')} cidade, upper({blank('uf')}) uf, lower({blank('email')}) email,
  {digits('telefone')} telefone, dt_extracao from ({latest('s_cliente')})"""
CTE["k_condutor"] = f"""select {nk('src_id')} condutor_nk, {nk('src_cliente_id')} cliente_nk, src_id, grupo_fonte, src_cliente_id,
  coalesce({blank('nome')}, 'Condutor nao informado') nome, {digits('cnh')} cnh, validade, upper({blank('categoria')}) categoria,
  dt_extracao from ({latest('s_condutor')})"""
CTE["k_grupo"] = f"""select {nk('src_id')} grupo_veiculo_nk, src_id, grupo_fonte,
  coalesce({blank('nome')}, 'Grupo nao informado') nome, coalesce({blank('categoria')}, 'Sem categoria') categoria,
  diaria, dt_extracao from ({latest('s_grupo')})"""
CTE["k_empresa"] = f"""select empresa_nk, src_empresa_id, grupo_fonte, nome_empresa, dt_extracao from (
  select {empresa_nk('src_empresa_id', 'n')} empresa_nk, src_empresa_id, grupo_fonte,
    coalesce(n, 'Empresa G' || cast(grupo_fonte as varchar)) nome_empresa, max(dt_extracao) dt_extracao
  from (select grupo_fonte, src_empresa_id, {blank('nome_empresa')} n, dt_extracao from s_patio
        where src_empresa_id is not null or {blank('nome_empresa')} is not null
        union all select grupo_fonte, src_empresa_id, {blank('nome_empresa')}, dt_extracao from s_veiculo)
  group by grupo_fonte, src_empresa_id, n)
  qualify row_number() over (partition by empresa_nk order by src_empresa_id nulls last, nome_empresa) = 1"""
CTE["k_patio"] = f"""select {nk('src_id')} patio_nk, {empresa_nk('src_empresa_id', 'nome_empresa')} empresa_nk, src_id,
  grupo_fonte, src_empresa_id, coalesce({blank('nome')}, 'Patio nao informado') nome, {blank('cidade')} cidade,
  coalesce(capacidade, 0) capacidade,
  coalesce({blank('nome_empresa')}, 'Empresa G' || cast(grupo_fonte as varchar)) nome_empresa, dt_extracao
  from ({latest('s_patio')})"""
CTE["k_veiculo"] = f"""select {nk('src_id')} veiculo_nk, {nk('src_grupo_id')} grupo_veiculo_nk,
  {empresa_nk('src_empresa_id', 'nome_empresa')} empresa_nk, src_id, grupo_fonte, src_grupo_id, src_empresa_id,
  {placa('placa')} placa, {placa('placa')} = 'SEMPLACA' flag_placa_imputada, {blank('chassi')} chassi,
  coalesce({blank('modelo')}, 'Modelo nao informado') modelo, coalesce({blank('marca')}, 'Marca nao informada') marca,
  {blank('cor')} cor, if({has('tipo_mecanizacao', 'auto')}, 'automatico', 'manual') tipo_mecanizacao,
  coalesce(ar_condicionado, false) ar_condicionado, coalesce(adaptado_cadeirante, false) adaptado_cadeirante,
  {veiculo_st('status')} status,
  coalesce({blank('nome_empresa')}, 'Empresa G' || cast(grupo_fonte as varchar)) nome_empresa, dt_extracao
  from ({latest('s_veiculo')})"""
CTE["k_tempo"] = calendario("""(
  select cast(coalesce(data_reserva, data_solicitacao) as date) data from s_reserva
  union select cast(data_inicio as date) from s_reserva union select cast(data_fim as date) from s_reserva
  union select cast(coalesce(created_at, data_retirada_realizada, data_retirada_prevista) as date) from s_locacao
  union select cast(data_retirada_realizada as date) from s_locacao
  union select cast(data_devolucao_realizada as date) from s_locacao
  union select cast(data_movimentacao as date) from s_mov) where data is not null""")
CTE["k_reserva"] = f"""select {nk('src_id')} reserva_nk, {nk('src_cliente_id')} cliente_nk, {nk('src_grupo_id')} grupo_veiculo_nk,
  {nk('src_patio_retirada_id')} patio_retirada_nk, {nk('src_patio_devolucao_id')} patio_devolucao_nk, * exclude (status),
  {ymd('d_reserva')} id_data_reserva, {ymd('d_inicio')} id_data_inicio, {ymd('d_fim')} id_data_fim,
  coalesce(date_diff('day', d_reserva, d_inicio), 0) antecedencia_dias, date_diff('day', d_inicio, d_fim) duracao_prevista_dias,
  {reserva_st('status')} status from (
    select *, cast(coalesce(data_reserva, data_solicitacao, dt_extracao) as date) d_reserva,
      cast(data_inicio as date) d_inicio, cast(data_fim as date) d_fim from ({latest('s_reserva')}))"""
CTE["k_locacao"] = f"""select {nk('src_id')} locacao_nk, {nk('src_reserva_id')} reserva_nk, {nk('src_veiculo_id')} veiculo_nk,
  {nk('src_condutor_id')} condutor_nk, {nk('src_cliente_id')} cliente_nk, {nk('src_patio_retirada_id')} patio_retirada_nk,
  {nk('src_patio_devolucao_id')} patio_devolucao_nk, * exclude (status),
  {incl('ret_prev', 'dev_prev')} dias_previstos, {incl('ret', 'dev')} dias_realizados, {late('dev', 'dev_prev')} atraso_devolucao_dias,
  case when dev is null then date_diff('day', date '{AS_OF}', dev_prev) end dias_para_devolucao,
  case when km_entrega is not null and km_devolucao is not null then greatest(km_devolucao - km_entrega, 0) end km_rodado,
  coalesce(nullif(preco_final, 0), nullif(valor_total, 0), nullif(valor_final, 0),
    nullif(valor_atraso + coalesce(valor_reparos, 0), 0), 0) valor_cobrado,
  coalesce(nullif(valor_atraso, 0), coalesce({late('dev', 'dev_prev')}, 0) * coalesce(diaria, 0)) valor_multa_atraso,
  coalesce(valor_atraso, 0) = 0 flag_multa_estimada, src_reserva_id is not null reserva_previa,
  case when {has('status', 'cancel')} then 'cancelada' when dev is not null then 'finalizada' when ret is not null then 'aberta'
    else coalesce(nullif(lower(trim(status)), ''), 'registrada') end status from (
    select l.*, cast(coalesce(created_at, data_retirada_realizada, data_retirada_prevista, l.dt_extracao) as date) registro,
      cast(data_retirada_prevista as date) ret_prev, cast(data_retirada_realizada as date) ret,
      cast(data_devolucao_prevista as date) dev_prev, cast(data_devolucao_realizada as date) dev, gr.diaria
    from ({latest('s_locacao')}) l
    left join k_veiculo v on v.grupo_fonte = l.grupo_fonte and v.src_id = l.src_veiculo_id
    left join k_grupo gr on gr.grupo_veiculo_nk = v.grupo_veiculo_nk)"""
CTE["k_cobranca"] = f"""select {nk('src_locacao_id')} locacao_nk, grupo_fonte, count(*) qtd_cobrancas,
  cast(sum(coalesce(valor, 0)) as decimal(12,2)) valor_cobranca,
  case when bool_or(st = 'pendente') then 'pendente' when bool_or(st = 'em_atraso') then 'em_atraso'
    when bool_and(st = 'pago') then 'pago' when bool_and(st = 'cancelada') then 'cancelada' else 'parcial' end status_cobranca,
  max(data_pagamento) data_ultimo_pagamento, max(dt_extracao) dt_extracao
  from (select *, {cobranca_st('status')} st from s_cobranca) group by grupo_fonte, src_locacao_id"""
CTE["k_mov"] = f"""select {nk('src_id')} movimentacao_patio_nk, {nk('src_veiculo_id')} veiculo_nk, {nk('src_origem_id')} patio_origem_nk,
  {nk('src_destino_id')} patio_destino_nk, * exclude (motivo, data_movimentacao), cast(data_movimentacao as date) data_movimentacao,
  {blank('motivo')} motivo from ({latest('s_mov')})"""

# --- star, natural keys standing in for surrogate keys --------------------------------------------

CTE["d_veiculo"] = """select v.*, e.nome_empresa empresa, g.nome grupo from k_veiculo v
  join k_grupo g on g.grupo_veiculo_nk = v.grupo_veiculo_nk join k_empresa e on e.empresa_nk = v.empresa_nk"""
CTE["d_tempo"] = calendario("""(select unnest(generate_series(min(d), max(d), interval 1 day))::date data from (
  select data d from k_tempo union all select d_reserva from k_reserva union all select d_inicio from k_reserva
  union all select d_fim from k_reserva union all select registro from k_locacao union all select ret_prev from k_locacao
  union all select ret from k_locacao union all select dev_prev from k_locacao union all select dev from k_locacao
  union all select data_movimentacao from k_mov))""")
CTE["c_reserva"] = """select r.*, c.cliente_nk is null sem_cliente, g.grupo_veiculo_nk is null sem_grupo,
  pr.patio_nk is null or (r.patio_devolucao_nk is not null and pd.patio_nk is null) sem_patio, d_inicio is null sem_tempo
  from k_reserva r left join k_cliente c on c.cliente_nk = r.cliente_nk
  left join k_grupo g on g.grupo_veiculo_nk = r.grupo_veiculo_nk
  left join k_patio pr on pr.patio_nk = r.patio_retirada_nk left join k_patio pd on pd.patio_nk = r.patio_devolucao_nk"""
CTE["f_reserva"] = f"""select reserva_nk reserva_id, cliente_nk sk_cliente, grupo_veiculo_nk sk_grupo_veiculo,
  patio_retirada_nk sk_patio_retirada, patio_devolucao_nk sk_patio_devolucao, id_data_inicio sk_tempo_inicio,
  id_data_fim sk_tempo_fim, status status_reserva, 1 qtd_reservas, {incl('d_inicio', 'd_fim')} dias_reservados,
  status = 'cancelada' flag_cancelada, status = 'confirmada' flag_confirmada, status = 'espera' flag_espera, d_inicio
  from c_reserva where not (sem_cliente or sem_grupo or sem_patio or sem_tempo)"""
CTE["c_locacao"] = """select l.*, v.grupo_veiculo_nk sk_grupo_veiculo, v.empresa_nk sk_empresa,
  c.cliente_nk is null sem_cliente, cd.condutor_nk is null sem_condutor, v.veiculo_nk is null sem_veiculo,
  pr.patio_nk is null or (l.patio_devolucao_nk is not null and pd.patio_nk is null) sem_patio,
  cob.valor_cobranca, cob.status_cobranca
  from k_locacao l left join k_cliente c on c.cliente_nk = l.cliente_nk
  left join k_condutor cd on cd.condutor_nk = l.condutor_nk left join d_veiculo v on v.veiculo_nk = l.veiculo_nk
  left join k_patio pr on pr.patio_nk = l.patio_retirada_nk left join k_patio pd on pd.patio_nk = l.patio_devolucao_nk
  left join k_cobranca cob on cob.locacao_nk = l.locacao_nk"""
CTE["f_locacao"] = f"""select locacao_nk locacao_id, reserva_nk reserva_id, cliente_nk sk_cliente, condutor_nk sk_condutor,
  veiculo_nk sk_veiculo, sk_grupo_veiculo, sk_empresa, patio_retirada_nk sk_patio_retirada, patio_devolucao_nk sk_patio_devolucao,
  {ymd('ret_prev')} sk_tempo_retirada_prevista, {ymd('ret')} sk_tempo_retirada_realizada,
  {ymd('dev_prev')} sk_tempo_devolucao_prevista, {ymd('dev')} sk_tempo_devolucao_realizada, ret_prev, ret, dev_prev, dev,
  km_entrega, km_devolucao, km_rodado, dias_previstos, dias_realizados, atraso_devolucao_dias, 1 qtd_locacoes,
  coalesce(valor_cobranca, valor_cobrado) valor_cobranca, valor_multa_atraso, flag_multa_estimada, status_cobranca
  from c_locacao where not (sem_cliente or sem_condutor or sem_veiculo or sem_patio)"""
CTE["c_mov"] = """select m.*, v.veiculo_nk is null sem_veiculo, po.patio_nk is null or pd.patio_nk is null sem_patio,
  m.data_movimentacao is null sem_tempo
  from k_mov m left join d_veiculo v on v.veiculo_nk = m.veiculo_nk
  left join k_patio po on po.patio_nk = m.patio_origem_nk left join k_patio pd on pd.patio_nk = m.patio_destino_nk"""
CTE["f_mov"] = f"""select movimentacao_patio_nk movimentacao_patio_id, veiculo_nk sk_veiculo, patio_origem_nk sk_patio_origem,
  patio_destino_nk sk_patio_destino, {ymd('data_movimentacao')} sk_tempo_movimentacao, motivo, 1 qtd_movimentacoes
  from c_mov where not (sem_veiculo or sem_patio or sem_tempo)"""

# --- views ----------------------------------------------------------------------------------------

CTE["v_status"] = f"""select status_reserva, n total_reservas,
  {half_up('10000*n', 'sum(n) over ()')} / 100.0 percentual_status
  from (select status_reserva, count(*) n from f_reserva group by 1)"""
CTE["v_mes"] = f"""select year(d) ano, month(d) mes, {MESES}[month(d)] nome_mes, count(*) total_locacoes,
  {half_up('100*sum(km_rodado)::bigint', 'count(km_rodado)')} km_centesimos, sum({cents('coalesce(valor_cobranca, 0)')})::bigint centavos
  from (select *, coalesce(ret, ret_prev) d from f_locacao) group by 1, 2, 3"""
CTE["v_ocupacao"] = """select g.nome grupo, g.categoria, count(*) total_locacoes, sum(coalesce(dias_realizados, 0)) dias_realizados,
  sum(coalesce(km_rodado, 0)) km_total_rodado from f_locacao f join k_grupo g on g.grupo_veiculo_nk = f.sk_grupo_veiculo
  group by 1, 2"""
CTE["v_mov"] = """select po.nome patio_origem, pd.nome patio_destino, count(*) total_movimentacoes
  from f_mov f join k_patio po on po.patio_nk = sk_patio_origem join k_patio pd on pd.patio_nk = sk_patio_destino group by 1, 2"""
CTE["v_matriz"] = f"""select patio_origem origem, patio_destino destino, total_movimentacoes,
  {half_up('10000*total_movimentacoes', 'sum(total_movimentacoes) over (partition by patio_origem)')} centesimos from v_mov"""
CTE["v_clientes"] = f"""select c.cliente_nk, c.nome cliente, c.tipo, c.cidade, coalesce(r.n, 0) total_reservas,
  coalesce(l.n, 0) total_locacoes, coalesce(l.v, 0) centavos
  from (select sk_cliente, count(*) n from f_reserva group by 1) r
  full join (select sk_cliente, count(*) n, sum({cents('coalesce(valor_cobranca, 0)')})::bigint v from f_locacao group by 1) l
    on l.sk_cliente = r.sk_cliente
  join k_cliente c on c.cliente_nk = coalesce(r.sk_cliente, l.sk_cliente)"""
CTE["v_atrasos"] = """select f.locacao_id, c.nome cliente, v.placa || ' - ' || v.marca || ' ' || v.modelo veiculo,
  p.nome patio_devolucao, f.dev_prev data_prevista, f.dev data_realizada, f.atraso_devolucao_dias atraso_em_dias
  from f_locacao f join k_cliente c on c.cliente_nk = f.sk_cliente join k_veiculo v on v.veiculo_nk = f.sk_veiculo
  left join k_patio p on p.patio_nk = f.sk_patio_devolucao where f.atraso_devolucao_dias > 0"""

# --- operational schema ---------------------------------------------------------------------------

CTE["o_empresa_locadora"] = """select s_suppkey id, s_name nome,
  'CNPJ-' || cast(case when s_suppkey%10=9 then s_suppkey-1 else s_suppkey end as varchar) cnpj from supplier"""
CTE["o_cliente"] = """select c_custkey id, c_name nome,
  case c_mktsegment when 'BUILDING' then 'PJ' when 'MACHINERY' then 'XX' else 'PF' end tipo from customer"""
CTE["o_condutor"] = """select c_custkey id, case when c_custkey%50=49 then -c_custkey else c_custkey end cliente_id,
  'Condutor ' || cast(c_custkey as varchar) nome,
  'CNH-' || cast(case when c_custkey%40=39 then c_custkey-39 else c_custkey end as varchar) cnh from customer"""
CTE["o_grupo_veiculo"] = "select r_regionkey id, r_name nome from region"
CTE["o_veiculo"] = """select p_partkey id,
  case when p_partkey%60<>59 then 'P' || cast(case when p_partkey%30=28 then p_partkey-1 else p_partkey end as varchar) end placa,
  'C' || cast(case when p_partkey%45=44 then p_partkey-1 else p_partkey end as varchar) chassi,
  case p_size%3 when 0 then 'automatico' when 1 then 'manual' else 'cvt' end tipo_mecanizacao,
  case p_size%7 when 0 then 'manutencao' when 1 then 'alugado' when 2 then 'vendido' else 'disponivel' end status,
  p_size%6 grupo_id, p_partkey%11 empresa_id from part"""
CTE["o_acessorio"] = "select r_regionkey id, case when r_regionkey in (3,4) then 'GPS' else r_name end nome from region"
CTE["o_veiculo_acessorio"] = "select distinct l_partkey veiculo_id, l_linenumber acessorio_id from lineitem"
CTE["o_patio"] = "select n_nationkey id, n_name nome from nation"
CTE["o_vaga"] = """select s_name codigo, s_nationkey + case when s_suppkey%33=0 then 50 else 0 end patio_id,
  case when s_suppkey%3=0 then 'ocupada' when s_suppkey%20=1 then 'quebrada' else 'livre' end status from supplier"""
CTE["o_reserva"] = """select src_id id, src_cliente_id cliente_id, src_grupo_id-1 grupo_id, src_patio_retirada_id patio_retirada_id,
  src_patio_devolucao_id patio_devolucao_id, data_inicio, data_fim,
  case src_id%5 when 0 then 'cancelada' when 1 then 'espera' when 2 then 'confirmada' else lower(status) end status from s_reserva"""
CTE["o_locacao"] = """select src_id id, case when src_id%10<=2 then src_id//10 end reserva_id, src_veiculo_id veiculo_id,
  src_condutor_id condutor_id, src_patio_retirada_id patio_retirada_id, src_patio_devolucao_id patio_devolucao_id,
  data_retirada_prevista, data_retirada_realizada,
  case when src_id%53=0 then data_devolucao_prevista - interval 9 day else data_devolucao_prevista end data_devolucao_prevista,
  data_devolucao_realizada, case when src_id%59<>0 then km_entrega-100 end km_entrega, km_devolucao, estado_entrega,
  estado_devolucao, created_at from s_locacao"""
CTE["o_cobranca"] = """select l_orderkey*10+l_linenumber id, case when l_linenumber<3 then l_orderkey*10+1 end locacao_id,
  cast(l_extendedprice as decimal(12,2)) - 2000 valor,
  case when l_returnflag='A' then 'pago' when l_returnflag='R' then 'cancelado' when l_linestatus='O' then 'pendente'
    else 'estornado' end status, cast(l_shipdate as date) data_pagamento from lineitem"""
CTE["o_seguro"] = "select n_nationkey id, n_name tipo, n_nationkey*10-20 valor from nation"
CTE["o_locacao_seguro"] = "select l_orderkey*10+l_linenumber locacao_id, l_suppkey%30 seguro_id from lineitem"
CTE["o_foto"] = "select event_id id, user_id veiculo_id from events"
CTE["o_manutencao"] = "select event_id id, user_id*20 veiculo_id from events"
CTE["o_movimentacao_patio"] = """select event_id id, user_id veiculo_id, user_id%25 origem_patio_id,
  (event_id*7+3)%25 destino_patio_id, ts data_movimentacao, event_type motivo from events"""

# --- extraction log and telemetry -----------------------------------------------------------------

CTE["p_log"] = """select grupo_fonte, tabela_stg, dt_extracao, qtd_registros, status from (
  select cast(o_custkey%4+1 as int) grupo_fonte, case when o_orderstatus='F' then 'OK' else 'ERR' end status,
    min(o_orderdate) + interval 1500 day dt_extracao, count(*) qtd_registros from orders group by 1, 2)
  cross join (select unnest(['reserva','locacao','cobranca','movimentacao_patio']) tabela_stg)"""
CTE["p_tel"] = """select event_id, user_id vehicle, ts, event_type, cast(value as decimal(12,2)) speed,
  event_type = 'error' critical from events"""

CTE["p_ar"] = """select l_partkey % (select max(user_id) + 1 from events) vehicle, cast(l_orderkey*10+l_linenumber as varchar) locacao_nk,
  timestamp '2024-01-01' + to_minutes((l_orderkey*7+l_linenumber*131) % 41760) inicio,
  case when l_linenumber <> 6 then timestamp '2024-01-01' + to_minutes((l_orderkey*7+l_linenumber*131) % 41760)
    + to_hours(cast(l_quantity as int)) end fim from lineitem"""

# --- what the audits are to look at, written out apart from the library's own lists -----------------

#: Staging tables and the columns that must be filled.
MANDATORY = {"cliente": ("src_id", "nome"), "veiculo": ("src_id", "placa"), "condutor": ("src_id", "cnh")}
#: (table, key column, its CTE, referenced table's CTE and key), as the star's natural keys.
STAR_LINKS = (
    ("dim_veiculo", "sk_grupo_veiculo", "d_veiculo", "grupo_veiculo_nk", "k_grupo", "grupo_veiculo_nk"),
    ("dim_veiculo", "sk_empresa", "d_veiculo", "empresa_nk", "k_empresa", "empresa_nk"),
    ("fato_reserva", "sk_cliente", "f_reserva", "sk_cliente", "k_cliente", "cliente_nk"),
    ("fato_reserva", "sk_grupo_veiculo", "f_reserva", "sk_grupo_veiculo", "k_grupo", "grupo_veiculo_nk"),
    ("fato_reserva", "sk_patio_retirada", "f_reserva", "sk_patio_retirada", "k_patio", "patio_nk"),
    ("fato_reserva", "sk_patio_devolucao", "f_reserva", "sk_patio_devolucao", "k_patio", "patio_nk"),
    ("fato_locacao", "sk_cliente", "f_locacao", "sk_cliente", "k_cliente", "cliente_nk"),
    ("fato_locacao", "sk_condutor", "f_locacao", "sk_condutor", "k_condutor", "condutor_nk"),
    ("fato_locacao", "sk_veiculo", "f_locacao", "sk_veiculo", "d_veiculo", "veiculo_nk"),
    ("fato_locacao", "sk_grupo_veiculo", "f_locacao", "sk_grupo_veiculo", "k_grupo", "grupo_veiculo_nk"),
    ("fato_locacao", "sk_empresa", "f_locacao", "sk_empresa", "k_empresa", "empresa_nk"),
    ("fato_locacao", "sk_patio_retirada", "f_locacao", "sk_patio_retirada", "k_patio", "patio_nk"),
    ("fato_locacao", "sk_patio_devolucao", "f_locacao", "sk_patio_devolucao", "k_patio", "patio_nk"),
    ("fato_veiculo_no_patio", "sk_veiculo", "f_mov", "sk_veiculo", "d_veiculo", "veiculo_nk"),
    ("fato_veiculo_no_patio", "sk_patio_origem", "f_mov", "sk_patio_origem", "k_patio", "patio_nk"),
    ("fato_veiculo_no_patio", "sk_patio_destino", "f_mov", "sk_patio_destino", "k_patio", "patio_nk"),
)
#: Warehouse categoricals: field, CTE, column, allowed labels.
LABELLED = (
    ("dim_cliente.tipo", "k_cliente", "tipo", "'PF', 'PJ'"),
    ("dim_veiculo.tipo_mecanizacao", "d_veiculo", "tipo_mecanizacao", "'automatico', 'manual'"),
    ("dim_veiculo.status", "d_veiculo", "status", "'disponivel', 'alugado', 'manutencao', 'indisponivel', 'desconhecido'"),
    ("fato_reserva.status_reserva", "f_reserva", "status_reserva", "'ativa', 'confirmada', 'cancelada', 'espera', 'desconhecida'"),
    ("fato_locacao.status_cobranca", "f_locacao", "status_cobranca", "'pendente', 'em_atraso', 'pago', 'cancelada', 'parcial'"),
)
#: Operational references: child, column, parent, what a delete does.
FOREIGN = (
    ("condutor", "cliente_id", "cliente", "RESTRICT"), ("veiculo", "grupo_id", "grupo_veiculo", "RESTRICT"),
    ("veiculo", "empresa_id", "empresa_locadora", "RESTRICT"), ("veiculo_acessorio", "veiculo_id", "veiculo", "CASCADE"),
    ("veiculo_acessorio", "acessorio_id", "acessorio", "CASCADE"), ("vaga", "patio_id", "patio", "CASCADE"),
    ("reserva", "cliente_id", "cliente", "RESTRICT"), ("reserva", "grupo_id", "grupo_veiculo", "RESTRICT"),
    ("reserva", "patio_retirada_id", "patio", "RESTRICT"), ("reserva", "patio_devolucao_id", "patio", "RESTRICT"),
    ("locacao", "reserva_id", "reserva", "SET NULL"), ("locacao", "veiculo_id", "veiculo", "RESTRICT"),
    ("locacao", "condutor_id", "condutor", "RESTRICT"), ("locacao", "patio_retirada_id", "patio", "RESTRICT"),
    ("locacao", "patio_devolucao_id", "patio", "RESTRICT"), ("cobranca", "locacao_id", "locacao", "SET NULL"),
    ("locacao_seguro", "locacao_id", "locacao", "CASCADE"), ("locacao_seguro", "seguro_id", "seguro", "RESTRICT"),
    ("foto", "veiculo_id", "veiculo", "CASCADE"), ("manutencao", "veiculo_id", "veiculo", "CASCADE"),
    ("movimentacao_patio", "veiculo_id", "veiculo", "RESTRICT"), ("movimentacao_patio", "origem_patio_id", "patio", "RESTRICT"),
    ("movimentacao_patio", "destino_patio_id", "patio", "RESTRICT"),
)

_NAMES = re.compile(r"\b(" + "|".join(sorted(CTE, key=len, reverse=True)) + r")\b")


def statement(body: str) -> str:
    """``body`` preceded by the common table expressions it needs, in dependency order."""
    ordered: list[str] = []

    def visit(text: str, trail: tuple[str, ...] = ()) -> None:
        for name in dict.fromkeys(_NAMES.findall(text)):
            if name not in ordered and name not in trail:
                visit(CTE[name], (*trail, name))
                ordered.append(name)

    visit(body)
    if not ordered:
        return body
    return "with " + ",\n".join(f"{n} as ({CTE[n]})" for n in ordered) + "\n" + body


SQL_TYPES = {"i": "bigint", "d": "double", "s": "varchar", "b": "boolean"}


def typed(body: str, columns: dict[str, str]) -> str:
    """The statement with every output column named and cast as the query declares it."""
    outputs = ", ".join(f"cast({c} as {SQL_TYPES[t]}) as {c}" for c, t in columns.items())
    return statement(f"select {outputs} from ({body}) q")
