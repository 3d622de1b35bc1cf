"""Settlement report kinds: table name, partition column and typed columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The six report kinds (file prefix, table, partition column) and the columns
# of each table in file order, with their types.
REPORT_TABLES = {
    "ajustes": ("Ajustes", "data_do_ajuste"),
    "pagamentos_futuros": ("PagamentosFuturos", "data_original_da_venda"),
    "cobrancas_em_aberto": ("CobrancasEmAberto", "data_de_criacao_do_debito"),
    "recebidos": ("Recebidos", "data"),
    "pagamentos": ("Pagamentos", "data_original_da_venda"),
    "cancelamentos_e_contestacoes": ("CancelamentosEContestacoes", "data_original_da_venda"),
}

REPORT_COLUMNS = {
    "Ajustes": (
        "updated_on date, ID_ajuste string, agencia string, banco string, bandeira_ajustada string, "
        "conta_corrente string, data_do_ajuste date, data_do_lancamento date, forma_de_compensacao "
        "string, motivo string, nome_do_estabelecimento_cobrado string, "
        "nome_do_estabelecimento_de_origem_da_cobranca string, numero_do_estabelecimento_cobrado string, "
        "numero_do_estabelecimento_de_origem_da_cobranca string, resumo_de_vendas_numero_do_lote_ajustado "
        "string, tipo_do_ajuste string, valor_ainda_pendente double, valor_cobrado_nesta_data double, "
        "valor_creditado_nesta_data double, valor_total_ja_cobrado double, valor_total_original_do_ajuste "
        "double"
    ),
    "PagamentosFuturos": (
        "updated_on date, NSU_CV string, TID string, agencia string, banco string, bandeira string, "
        "cancelamento_contestacao string, codigo_IATA string, conta_corrente string, data_do_cancelamento "
        "date, data_original_da_venda date, data_prevista_do_recebimento date, estabelecimento string, "
        "indicador_de_transacao_tokenizada string, modalidade string, negociada string, "
        "nome_do_estabelecimento string, numero_de_autorizacao string, numero_de_parcelas bigint, "
        "numero_do_cartao string, numero_do_pedido string, ordem_de_credito string, parcela bigint, "
        "percent double, resumo_de_vendas_numero_do_lote string, status string, taxa_MDR double, "
        "valor_MDR_descontado double, valor_bruto_da_parcela_atualizada double, "
        "valor_bruto_da_parcela_original double, valor_liquido_da_parcela double"
    ),
    "CobrancasEmAberto": (
        "updated_on date, NSU string, data_de_criacao_do_debito date, estabelecimento_da_cobranca string, "
        "motivo string, total_da_cobranca double, total_ja_cobrado double, valor_pendente double"
    ),
    "Recebidos": (
        "updated_on date, CNPJ_CPF_do_cessionario__cessao__ou_do_titular_do_recebivel__gravame_ string, "
        "banco_domicilio string, bandeira string, data date, estabelecimento string, modalidade string, "
        "negociadas string, nome_do_estabelecimento string, "
        "razao_Social_do_cessionario__cessao__ou_do_titular_do_recebivel__gravame_ string, status string, "
        "valor_depositado double"
    ),
    "Pagamentos": (
        "updated_on date, NSU_CV string, TID string, agencia string, banco string, bandeira string, "
        "cancelamento_contestacao string, codigo_IATA string, conta_corrente string, data_do_cancelamento "
        "date, data_do_recebimento date, data_original_da_venda date, data_original_de_vencimento date, "
        "estabelecimento string, indicador_de_transacao_tokenizada string, modalidade string, negociada "
        "string, nome_do_estabelecimento string, numero_da_autorizacao string, numero_de_parcelas bigint, "
        "numero_do_cartao string, numero_do_pedido string, parcela bigint, percent double, "
        "resumo_de_vendas_numero_do_lote string, status string, taxa_MDR double, valor_MDR_descontado "
        "double, valor_bruto_da_parcela_atualizada double, valor_bruto_da_parcela_original double, "
        "valor_liquido_da_parcela double"
    ),
    "CancelamentosEContestacoes": (
        "updated_on date, NSU_CV string, TID string, agencia string, aviso_do_cancelamento string, banco "
        "string, bandeira_ajustada string, bandeira_da_venda string, cancelamento_chargeback string, "
        "conta_corrente string, data_do_debito date, data_original_da_venda date, "
        "estabelecimento_ajustado string, estabelecimento_da_venda string, modalidade_ajustada string, "
        "modalidade_da_venda string, motivo_do_cancelamento string, nome_do_estabelecimento_ajustado "
        "string, nome_do_estabelecimento_da_venda string, numero_da_autorizacao string, "
        "numero_de_parcelas bigint, numero_do_pedido string, processo_de_contestacao string, "
        "resumo_de_vendas_numero_do_lote_ajustado string, resumo_de_vendas_numero_do_lote_da_venda "
        "string, valor_descontado double, valor_original_da_venda double"
    ),
}

# A kind that is never landed.
SKIPPED_KINDS = ("capa",)


@dataclass(frozen=True)
class ReportKind:
    kind: str
    table: str
    partition_by: str
    schema: T.StructType


def report_kind(kind: str) -> ReportKind | None:
    """Registered kind of a file prefix, or None for an unknown one."""
    entry = REPORT_TABLES.get(kind.lower())
    if entry is None:
        return None
    table, partition_by = entry
    return ReportKind(kind.lower(), table, partition_by, T.StructType.fromDDL(REPORT_COLUMNS[table]))
