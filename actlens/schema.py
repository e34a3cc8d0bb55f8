"""Logical tables as Spark schemas, and the vocabularies of their columns."""

from __future__ import annotations

from pyspark.sql.types import StructType

ATO = "id long not null, tipo_ato string not null, numero string, ano int, identificador string, emissor string, data_publicacao date, data_vigencia_inicio date, data_vigencia_fim date, eficacia_atual string, ementa string, url_pdf string, url_html string, metadados string, importado_de string, importado_em timestamp, criado_em timestamp, atualizado_em timestamp, status_vigencia string, link string, pdf_disponivel boolean, content_disponivel boolean, analise_completa boolean, fonte_origem string, ato_legacy_id int, legacy_table string, id_portal int, situacao_portal string"
ATO_CONTENT = "ato_id long not null, texto_completo string, origem_extracao string, processed_at timestamp, fonte_extracao string, caracteres int, paginas int, tipo_versao string, id_arquivo_binario int, pdf_path string"
ATO_MATERIA = "id long not null, ato_id long not null, ordem int not null, tributos array<string>, regimes array<string>, setores array<string>, trecho_canonico string, natureza string, tema_macro string, tema_especifico string, subtema string, tags array<string>, ementa_trecho string, tese_contribuinte string, tese_fazenda string, tese_adotada string, resultado string, fato_consultado string, solucao string, fundamentacao_resumo string, metadata_tematico string, posicionamento string, sinal string, embedding array<float>, embedding_source string, embedded_at timestamp, llm_model string, llm_processed_at timestamp, schema_version string, base_analise string"
MATERIA_TRIBUTO = "materia_id long not null, tributo_codigo string not null, regime string, codigo_receita string"
MATERIA_DISPOSITIVO = "id long not null, materia_id long, tipo_norma string, referencia string, dispositivo string, texto_resumido string, tipo_uso string"
MATERIA_CNAE = "materia_id long not null, cnae_codigo string not null, descricao string, relevancia string, confianca string"
ATO_RELACAO = "id long not null, ato_origem_id long not null, ato_destino_id long, destino_id_portal int, destino_externo string, tipo_relacao string not null, trecho_referencia string, data_relacao date, data_efeito date, parcial boolean, observacao string, fonte string, dispositivo_afetado string, criado_em timestamp"
ATO_CHUNKS = "id long not null, ato_id long not null, tipo_chunk string, seq int, texto string, embedding array<float>, metadata string"
ATO_SEGMENTO = "ato_id long not null, id_segmento long not null, versao_segmento int not null, ordem int, id_tipo_segmento int, id_assunto int, texto_integra string, is_original boolean, is_compilado boolean, is_tachado boolean, is_omitido boolean, is_agendado boolean, raw string, criado_em timestamp"
ATO_ALTERACAO = "id long not null, ato_alvo_id long not null, id_segmento_alvo long not null, ato_modificador_id long, id_ato_modificador_portal int, data_inicio_vigencia date, data_republicacao date, texto_anotacao string, raw_anotacao_id int, eh_agendamento boolean, texto_agendamento string, criado_em timestamp"
CONFLITO = "id long not null, tema_especifico string not null, materia_a_id long not null, materia_b_id long not null, similaridade decimal(6,4) not null, sinal_a string, sinal_b string, data_a date, data_b date, ato_b_supera boolean, formal_relacao_existe boolean, observacao string, criado_em timestamp"
ATO_COLETA = "ato_id long not null, pdf_status string not null, url_tentada string, http_status int, content_type string, bytes_baixados long, sha256 string, tentativas int not null, primeira_tentativa timestamp, ultima_tentativa timestamp, proxima_tentativa timestamp, erro string, origem string, observacao string, criado_em timestamp, atualizado_em timestamp"
ATO_TEXTO_VISAO = "ato_id long not null, visao string not null, sha256 string not null, texto string not null, caminho_json string, fonte string, run_id string, coletado_em timestamp"
ATO_MUDANCA = "id long not null, run_id string not null, ato_id long not null, tabela string not null, campo string not null, antes string, depois string, em timestamp"
ROTINA = "run_id string not null, inicio timestamp not null, fim timestamp, estado string not null, atos_coletados int, coletados_por_tipo map<string,int>, erros_coleta int, atos_categorizados int, materias_gravadas int, para_revisao int, erros_categorizacao int, lotes_enviados int, atos_enviados int, custo_usd decimal(10,2), base_atualizada_ate date, maquina string, resumo string"
TAXONOMIA = "codigo string not null, nome string, sigla string, sijut_value int, eficacia_default string, ativo boolean, natureza string"

TABLES = {
    "ato": ATO, "ato_content": ATO_CONTENT, "ato_materia": ATO_MATERIA, "materia_tributo": MATERIA_TRIBUTO, "materia_dispositivo": MATERIA_DISPOSITIVO,
    "materia_cnae": MATERIA_CNAE, "ato_relacao": ATO_RELACAO, "ato_chunks": ATO_CHUNKS, "ato_segmento": ATO_SEGMENTO, "ato_alteracao_historico": ATO_ALTERACAO,
    "conflito_temporal": CONFLITO, "ato_coleta": ATO_COLETA, "ato_texto_visao": ATO_TEXTO_VISAO, "ato_mudanca": ATO_MUDANCA, "rotina_execucao": ROTINA, "taxonomia_tipo_ato": TAXONOMIA,
}

KEYS = {
    "ato": ["id"], "ato_content": ["ato_id", "tipo_versao"], "ato_materia": ["ato_id", "ordem"], "materia_tributo": ["materia_id", "tributo_codigo", "regime"],
    "materia_cnae": ["materia_id", "cnae_codigo"], "ato_relacao": ["ato_origem_id", "ato_destino_id", "tipo_relacao"], "ato_chunks": ["ato_id", "tipo_chunk", "seq"],
    "ato_segmento": ["ato_id", "id_segmento", "versao_segmento"], "ato_alteracao_historico": ["ato_alvo_id", "id_segmento_alvo", "raw_anotacao_id"],
    "conflito_temporal": ["materia_a_id", "materia_b_id"], "ato_coleta": ["ato_id"], "ato_texto_visao": ["ato_id", "visao", "sha256"], "rotina_execucao": ["run_id"], "taxonomia_tipo_ato": ["codigo"],
}

#: Fixed vocabularies of checked columns.
SINAL = ["AUTORIZA", "VEDA", "CONDICIONA", "INDETERMINADO"]
BASE_ANALISE = ["texto", "ementa"]
PDF_STATUS = ["nao_tentado", "baixado", "sem_pdf_no_portal", "erro_http", "erro_rede", "erro_extracao", "bloqueado"]
VISAO = ["original", "multivigente"]
ESTADO = ["ok", "com_erro", "falhou"]


def struct(name: str) -> StructType:
    """The schema of a logical table."""
    return StructType.fromDDL(TABLES[name])
