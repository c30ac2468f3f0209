"""Small hand-made sources with known answers."""

from conftest import at, on
from rodovia.sources.registry import FrameSource


def frames(spark, tables):
    return FrameSource({name: spark.createDataFrame(rows, ddl) for name, (ddl, rows) in tables.items()})


def g1_tables():
    return {
        "empresa_locadora": ("id int, nome string", [(1, "Locadora Um")]),
        "cliente": ("id int, nome string, tipo string, cidade string", [
            (1, "Alice Prado", "PF", "Rio de Janeiro"), (2, "Comercio Delta", "PJ", "Niteroi"),
            (3, None, "PF", "Rio de Janeiro")]),
        "condutor": ("id int, cliente_id int, nome string, cnh string, validade date, categoria string", [
            (1, 1, "Alice Prado", "111.222-33", on(900), "b"), (2, 2, "Bento Luz", "55566677788", on(700), "D")]),
        "grupo_veiculo": ("id int, nome string, categoria string, diaria decimal(10,2)", [
            (1, "Economico", "Hatch", d(100)), (2, "Executivo", "Sedan", d(250))]),
        "veiculo": ("id int, placa string, chassi string, modelo string, marca string, cor string, "
                    "tipo_mecanizacao string, ar_condicionado boolean, adaptado_cadeirante boolean, "
                    "status string, grupo_id int, empresa_id int", [
            (1, "abc-1d23", "CH1", "Mobi", "Fiat", "Branco", "manual", True, False, "disponivel", 1, 1),
            (2, "xyz9e88", "CH2", "Corolla", "Toyota", "Preto", "automatico", True, False, "status_zoado", 2, 1),
            (3, None, "CH3", "Argo", "Fiat", "Prata", "manual", False, True, "alugado", 1, 1)]),
        "patio": ("id int, nome string, cidade string", [(1, "Patio Centro", "Rio de Janeiro"),
                                                         (2, "Patio Sul", "Rio de Janeiro")]),
        "vaga": ("codigo string, patio_id int, status string", [
            ("A1", 1, "livre"), ("A2", 1, "ocupada"), ("B1", 2, "livre")]),
        "reserva": ("id int, cliente_id int, grupo_id int, patio_retirada_id int, patio_devolucao_id int, "
                    "data_inicio timestamp_ntz, data_fim timestamp_ntz, status string", [
            (1, 1, 1, 1, 1, at(-3), at(-1), "confirmada"), (2, 2, 2, 1, 2, at(-2), at(0), "cancelada"),
            (3, 1, 1, 2, 2, at(-2), at(-1), "estado_invalido")]),
        "locacao": ("id int, reserva_id int, veiculo_id int, condutor_id int, patio_retirada_id int, "
                    "patio_devolucao_id int, data_retirada_prevista timestamp_ntz, "
                    "data_retirada_realizada timestamp_ntz, data_devolucao_prevista timestamp_ntz, "
                    "data_devolucao_realizada timestamp_ntz, km_entrega int, km_devolucao int, "
                    "estado_entrega string, estado_devolucao string, created_at timestamp_ntz", [
            (1, 1, 1, 1, 1, 1, at(-5), at(-5), at(-3), at(-1), 10000, 10350, "ok", "ok", at(-5)),
            (2, 2, 2, 2, 1, 2, at(-5), at(-5), at(-1), at(-3), 20000, 20100, "ok", "ok", at(-5)),
            (3, 3, 3, 1, 2, 2, at(-4), at(-4), at(-2), at(-1), 5000, 4000, "ok", "avariado", at(-4))]),
        "cobranca": ("id int, locacao_id int, valor decimal(10,2), status string, data_pagamento date", [
            (1, 1, d(500), "pago", on(-1)), (2, 2, d(750), "pago", on(-3)), (3, 3, d(300), "pendente", None)]),
        "movimentacao_patio": ("id int, veiculo_id int, origem_patio_id int, destino_patio_id int, "
                               "data_movimentacao timestamp_ntz, motivo string", [
            (1, 1, 1, 2, at(-2), "realocacao"), (2, 3, 2, 1, at(-1), "manutencao")]),
    }


def d(n):
    from decimal import Decimal
    return Decimal(n).quantize(Decimal("0.01"))


def g2_tables():
    return {
        "empresa": ("id_empresa int, nome_empresa string", [(7, "Locadora Dois")]),
        "endereco": ("id_endereco int, cidade string, uf string", [(1, "Santos", "sp"), (2, "Campinas", "SP")]),
        "cliente": ("id_cliente int, nome_completo string, id_endereco int, id_documento int, email string, "
                    "telefone string", [(1, "Caio", 1, 1, "CAIO@X.COM", "(13) 9-9"), (2, "Dora", 2, 2, None, None)]),
        "documento_cliente": ("id_documento int, cnh string", [(1, "123"), (2, None)]),
        "grupo": ("id_grupo int, nome string, descricao string, diaria_grupo decimal(10,2)",
                  [(1, "Basico", None, d(80))]),
        "especificacoes_const": ("id_spec_const int, direcao_automatica int, ar_condicionado int",
                                 [(1, 1, 1), (2, 0, 0)]),
        "especificacoes_var": ("id_spec_var int, gasolina int", [(1, 90), (2, 40)]),
        "veiculo": ("id_veiculo int, placa string, chassi string, modelo string, marca string, "
                    "id_spec_const int, id_grupo int", [(1, "G2A", "c1", "m", "f", 1, 1), (2, "G2B", "c2", "m", "f", 2, 1)]),
        "patio": ("id_patio int, nome_patio string, id_endereco int, id_empresa int",
                  [(1, "Porto", 1, 7), (2, "Vazio", 2, 7)]),
        "vaga": ("id_vaga int, id_patio int, id_veiculo int", [(1, 1, 1), (2, 1, None)]),
        "reserva": ("id_reserva int, id_cliente int, id_grupo int, id_patio_origem int, id_patio_fim int, "
                    "data_inicio_combinada timestamp_ntz, data_fim_combinada timestamp_ntz, "
                    "data_reserva timestamp_ntz, estado_reserva int, preco_final decimal(10,2)", [
            (1, 1, 1, 1, 1, at(-2), at(1), at(-9), 0, d(240)), (2, 1, 1, 1, 1, at(-90), at(-88), at(-95), 1, d(99)),
            (3, 2, 1, 1, 2, at(-1), at(1), at(-3), 2, d(160)), (4, 2, 1, 1, 2, at(-1), at(1), at(-3), 9, d(0)),
            (5, 2, 1, 1, 2, at(-90), at(-80), at(-99), 2, d(10))]),
        "locacao": ("id_locacao int, id_reserva int, id_veiculo int, id_patio int, data_locacao timestamp_ntz, "
                    "id_spec_var int, id_caucao int", [(1, 1, 1, 1, at(-2), 1, 1), (2, 3, 2, 1, at(-60), 1, 2)]),
        "devolucao": ("id_devolucao int, id_locacao int, data_devolucao timestamp_ntz, id_spec_var int, id_vaga int",
                      [(11, 1, at(0), 2, 2)]),
        "custos_devolucao": ("id_caucao int, valor_atraso decimal(10,2), valor_reparos decimal(10,2)",
                             [(1, d(50), d(30))]),
    }


def g3_tables():
    return {
        "empresa": ("id_empresa int, nome_empresa string", [(1, "Locadora Tres"), (2, "Outra Tres")]),
        "endereco": ("id_endereco int, cidade string, uf string", [(1, "Recife", "PE")]),
        "cliente": ("id_cliente int, tipo_cliente string, id_endereco int, email_cliente string, "
                    "telefone_cliente string", [(1, "PF", 1, "a@b", "81"), (2, "PJ", 1, None, None)]),
        "cliente_pf": ("id_cliente int, nome_cliente string", [(1, "Edu")]),
        "cliente_pj": ("id_cliente int, razao_social string", [(2, "Frete SA")]),
        "motorista": ("id_motorista int, id_cliente int, nome_motorista string, numero_cnh string, "
                      "validade_cnh date, categoria_cnh string", [(1, 2, "Fabi", "9", on(100), "e")]),
        "categoria": ("id_categoria int, nome_categoria string, descricao_categoria string, "
                      "valor_diaria_base decimal(10,2)", [(1, "Van", "carga", d(300))]),
        "veiculo": ("id_veiculo int, placa string, chassi string, modelo string, marca string, tipo_cambio string, "
                    "possui_ar_condicionado int, status_veiculo string, id_categoria int, id_empresa int",
                    [(1, "G3A", "c", "m", "v", "Automatica", 1, "Indisponivel", 1, 2)]),
        "patio": ("id_patio int, nome_patio string, id_endereco int, capacidade int, id_empresa int",
                  [(1, "Cais", 1, 40, 1)]),
        "reserva": ("id_reserva int, id_cliente int, id_categoria int, id_patio_previsto_retirada int, "
                    "id_patio_previsto_devolucao int, data_hora_reserva timestamp_ntz, "
                    "data_previsao_retirada timestamp_ntz, data_previsao_devolucao timestamp_ntz, "
                    "status_reserva string, valor_previsto decimal(10,2)", [
            (1, 2, 1, 1, 1, at(-3), at(-2), at(2), "OK", d(900)),
            (2, 2, 1, 1, 1, at(-300), at(-290), at(-280), "Cancelado", d(1)),
            (3, 2, 1, 1, 1, at(-300), at(-290), at(-280), None, d(1))]),
        "locacao": ("id_locacao int, id_reserva int, id_veiculo int, id_motorista int, id_patio_real_retirada int, "
                    "id_patio_real_devolucao int, data_hora_retirada_real timestamp_ntz, "
                    "data_hora_devolucao_real timestamp_ntz, km_retirada int, km_devolucao int, "
                    "valor_total_final decimal(10,2), status_locacao string", [
            (1, 1, 1, 1, 1, 1, at(-2), at(-1), 10, 60, d(600), "ok"),
            (2, None, 1, 1, 1, None, at(-200), None, 60, None, None, "aberta")]),
    }


def g4_tables():
    return {
        "cliente": ("id_cliente int, nome_razao_social string, tipo_cliente string", [(1, "Gil", "PF")]),
        "motorista": ("id_motorista int, id_cliente int, nome_condutor string, numero_cnh string, "
                      "data_expiracao_cnh date, categoria_habilitacao string", [(1, 1, "Gil", "77", on(5), "B")]),
        "grupo_veiculo": ("id_grupo int, nome_categoria string, classe_luxo string, valor_diaria decimal(10,2)",
                          [(1, "Luxo", "A", d(500))]),
        "veiculo": ("id_veiculo int, placa string, chassi string, modelo string, marca string, mecanizacao string, "
                    "ar_condicionado string, status_disponibilidade string, id_grupo int", [
            (1, "G4A", "c", "m", "v", "auto", "S", "avail", 1), (2, "G4B", "c", "m", "v", "man", "sim", "avail", 1),
            (3, "G4C", "c", "m", "v", "man", "0", "avail", 1), (4, "G4D", "c", "m", "v", "man", None, "x", 1)]),
        "patio": ("id_patio int, nome_localizacao string, capacidade_vagas int, empresa_dona string",
                  [(1, "Praca", 5, "Dona & Filhos")]),
        "reserva": ("id_reserva int, id_cliente int, id_grupo int, id_patio_retirada int, "
                    "data_hora_solicitacao timestamp_ntz, data_hora_retirada_prevista timestamp_ntz, "
                    "data_hora_devolucao_prevista timestamp_ntz, status_reserva string",
                    [(1, 1, 1, 1, at(-1), at(1), at(2), "Waiting")]),
        "locacao": ("id_locacao int, id_reserva int, id_veiculo int, id_motorista int, id_patio_saida int, "
                    "id_patio_chegada_realizada int, data_hora_retirada timestamp_ntz, "
                    "data_hora_devolucao_realizada timestamp_ntz, valor_final decimal(10,2)",
                    [(1, 1, 1, 1, 1, 1, at(-1), at(0), d(700))]),
    }
