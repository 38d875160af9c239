"""The same views as SQL text, for the independent check of every query."""

VIEWS = """
WITH base AS (
  SELECT l.*, o.o_orderdate, o.o_orderpriority, s.s_nationkey, c.c_nationkey,
    CASE WHEN l.l_orderkey % 33 <> 0
         THEN o.o_orderdate + to_hours(CAST(l.l_partkey % 24 AS INT)) + to_minutes(CAST(l.l_suppkey % 60 AS INT)) END AS pp,
    CAST(date_diff('day', o.o_orderdate, l.l_shipdate) AS INT) AS d,
    CAST(45 + 15 * (l.l_partkey % 12) AS INT) AS planejado,
    (l.l_returnflag = 'R' AND l.l_linestatus = 'O' AND l.l_linenumber = 7) AS cancelou
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey
), tempos AS (
  SELECT *, CASE WHEN NOT cancelou THEN pp + to_minutes(d) END AS pr FROM base
), voos0 AS (
  SELECT l_suppkey AS icao_empresa, l_partkey AS numero_voo, l_linestatus AS codigo_di, l_returnflag AS codigo_tipo_linha,
    s_nationkey AS icao_origem, c_nationkey AS icao_destino,
    pp AS partida_prevista_hora, pr AS partida_real_hora, pp + to_minutes(planejado) AS chegada_prevista_hora,
    pr + to_minutes(CAST(planejado - 10 + 5 * l_linenumber AS INT)) AS chegada_real_hora,
    CASE WHEN cancelou THEN 'CANCELADO' ELSE 'REALIZADO' END AS situacao_voo,
    CASE WHEN cancelou THEN CASE WHEN l_partkey % 3 = 0 THEN '' WHEN l_partkey % 3 = 2 THEN o_orderpriority END END AS codigo_justificativa,
    'lote-' || l_linenumber AS origem_arquivo, l_shipdate AS transformado_em, l_orderkey AS pedido, l_linenumber AS item
  FROM tempos
), voos AS (
  SELECT *, CAST(partida_prevista_hora AS DATE) AS partida_prevista_data, CAST(partida_real_hora AS DATE) AS partida_real_data,
    CAST(chegada_prevista_hora AS DATE) AS chegada_prevista_data, CAST(chegada_real_hora AS DATE) AS chegada_real_data,
    date_sub('minute', partida_prevista_hora, partida_real_hora) AS atraso_partida_min,
    date_sub('minute', chegada_prevista_hora, chegada_real_hora) AS atraso_chegada_min,
    date_sub('minute', partida_prevista_hora, partida_real_hora) - date_sub('minute', chegada_prevista_hora, chegada_real_hora) AS minutos_recuperados
  FROM voos0
), linhas AS (
  SELECT *, situacao_voo = 'REALIZADO' AS flag_realizado, situacao_voo = 'CANCELADO' AS flag_cancelado,
    coalesce(atraso_partida_min <= 15, false) AS partida_pontual, coalesce(atraso_chegada_min <= 15, false) AS chegada_pontual,
    coalesce(atraso_partida_min > 15, false) AS partida_atrasada, coalesce(atraso_partida_min > 60, false) AS partida_atraso_severo,
    date_sub('minute', partida_real_hora, chegada_real_hora) AS duracao_voo_min,
    CASE WHEN hour(partida_prevista_hora) < 6 THEN 'madrugada' WHEN hour(partida_prevista_hora) < 12 THEN 'manha'
         WHEN hour(partida_prevista_hora) < 18 THEN 'tarde' WHEN hour(partida_prevista_hora) < 24 THEN 'noite' END AS periodo_partida,
    partida_prevista_data AS data_partida_prevista,
    CAST(year(partida_prevista_data) AS INT) AS ano, CAST(month(partida_prevista_data) AS INT) AS mes,
    strftime(partida_prevista_data, '%B') AS nome_mes, CAST(day(partida_prevista_data) AS INT) AS dia,
    CAST(dayofweek(partida_prevista_data) + 1 AS INT) AS dia_semana_num, strftime(partida_prevista_data, '%A') AS nome_dia_semana,
    CAST(quarter(partida_prevista_data) AS INT) AS trimestre, strftime(partida_prevista_data, '%Y-%m') AS ano_mes,
    dayofweek(partida_prevista_data) IN (0, 6) AS fim_de_semana,
    CASE WHEN month(partida_prevista_data) IN (12, 1, 2) THEN 'verao' WHEN month(partida_prevista_data) IN (3, 4, 5) THEN 'outono'
         WHEN month(partida_prevista_data) IN (6, 7, 8) THEN 'inverno' WHEN month(partida_prevista_data) IN (9, 10, 11) THEN 'primavera' END AS estacao
  FROM voos
), cubo AS (
  SELECT ano_mes, icao_empresa, icao_origem, icao_destino, situacao_voo, periodo_partida, fim_de_semana, codigo_tipo_linha,
    CAST(count(*) AS BIGINT) AS voos, CAST(count(*) FILTER (WHERE flag_realizado) AS BIGINT) AS realizados,
    CAST(count(*) FILTER (WHERE flag_cancelado) AS BIGINT) AS cancelados,
    CAST(count(*) FILTER (WHERE partida_pontual) AS BIGINT) AS partidas_pontuais,
    CAST(count(*) FILTER (WHERE chegada_pontual) AS BIGINT) AS chegadas_pontuais,
    CAST(count(*) FILTER (WHERE partida_atrasada) AS BIGINT) AS partidas_atrasadas,
    CAST(count(*) FILTER (WHERE partida_atraso_severo) AS BIGINT) AS partidas_severas,
    CAST(count(atraso_partida_min) AS BIGINT) AS com_atraso_partida, CAST(sum(atraso_partida_min) AS BIGINT) AS soma_atraso_partida,
    CAST(count(atraso_chegada_min) AS BIGINT) AS com_atraso_chegada, CAST(sum(atraso_chegada_min) AS BIGINT) AS soma_atraso_chegada,
    CAST(count(duracao_voo_min) AS BIGINT) AS com_duracao, CAST(sum(duracao_voo_min) AS BIGINT) AS soma_duracao,
    CAST(count(*) FILTER (WHERE atraso_partida_min BETWEEN -60 AND 1440) AS BIGINT) AS com_atraso_plausivel,
    CAST(coalesce(sum(atraso_partida_min) FILTER (WHERE atraso_partida_min BETWEEN -60 AND 1440), 0) AS BIGINT) AS soma_atraso_plausivel
  FROM linhas GROUP BY ALL
), empresa AS (
  SELECT s.s_suppkey AS icao_empresa, s.s_name AS nome, coalesce(n.n_regionkey = 1, false) AS nacional,
    CASE WHEN s.s_suppkey % 10 < 2 THEN 'M0' WHEN s.s_suppkey % 10 = 2 THEN 'M1' END AS marca
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
), aerodromo0 AS (
  SELECT n.n_nationkey AS icao, n.n_name AS nome,
    CASE WHEN n.n_nationkey % 7 <> 3 THEN 'MUN_' || (n.n_nationkey % 20) END AS municipio,
    CASE WHEN n.n_nationkey % 7 <> 3 THEN 'R' || n.n_regionkey END AS uf,
    CASE WHEN n.n_nationkey % 7 <> 3 THEN r.r_name END AS estado,
    CASE WHEN n.n_nationkey % 5 <> 0 THEN -30::DOUBLE + 2.5::DOUBLE * n.n_nationkey END AS latitude,
    CASE WHEN n.n_nationkey % 5 <> 0 THEN -70::DOUBLE + 3.1::DOUBLE * n.n_nationkey END AS longitude
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
), aerodromo AS (
  SELECT *, coalesce(municipio, nome, CAST(icao AS VARCHAR)) AS rotulo FROM aerodromo0
), rota0 AS (
  SELECT v.icao_origem, v.icao_destino, count(*) AS voos,
    any_value(a.latitude) AS la, any_value(a.longitude) AS lo, any_value(b.latitude) AS lb, any_value(b.longitude) AS lp
  FROM voos v LEFT JOIN aerodromo a ON v.icao_origem = a.icao LEFT JOIN aerodromo b ON v.icao_destino = b.icao
  GROUP BY v.icao_origem, v.icao_destino
), rota1 AS (
  SELECT *, CASE WHEN la IS NOT NULL AND lo IS NOT NULL AND lb IS NOT NULL AND lp IS NOT NULL THEN
    round(2 * 6371 * asin(sqrt(power(sin(radians(lb - la) / 2), 2)
      + cos(radians(la)) * cos(radians(lb)) * power(sin(radians(lp - lo) / 2), 2))), 1) END AS distancia_km
  FROM rota0
), rota AS (
  SELECT icao_origem, icao_destino, distancia_km,
    CASE WHEN distancia_km IS NULL THEN 'Sem coordenadas' WHEN distancia_km < 500 THEN 'Curta (<500km)'
         WHEN distancia_km < 1500 THEN 'Media (500-1500km)' WHEN distancia_km < 3000 THEN 'Longa (1500-3000km)'
         ELSE 'Extra-longa (>3000km)' END AS faixa_distancia,
    icao_origem = icao_destino AS origem_igual_destino, voos
  FROM rota1
), tempo AS (
  SELECT ano_mes, max(ano) AS ano, max(mes) AS mes,
    list_extract(['jan','fev','mar','abr','mai','jun','jul','ago','set','out','nov','dez'], max(mes)) || '/' || max(ano) AS nome_mes,
    max(trimestre) AS trimestre, max(estacao) AS estacao, min(data_partida_prevista) AS primeiro_dia,
    max(data_partida_prevista) AS ultimo_dia, count(DISTINCT data_partida_prevista) AS dias_com_voo, count(*) AS voos,
    coalesce(max(ano) * 100 + max(mes), 999999) AS ordem
  FROM linhas GROUP BY ano_mes
), copias AS (
  SELECT s.s_suppkey, n.n_name, n.n_regionkey, 0 AS copia, s.s_name AS nome,
    CASE WHEN s.s_acctbal < 0 THEN 'INATIVA' ELSE 'ATIVA' END AS situacao, TIMESTAMP '2024-01-01 00:00:00' AS quando
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  UNION ALL
  SELECT s.s_suppkey, n.n_name, n.n_regionkey, 1, CASE WHEN s.s_suppkey % 3 <> 0 THEN s.s_name ELSE '' END,
    CASE WHEN s.s_suppkey % 4 = 0 THEN '' WHEN s.s_acctbal < 0 THEN 'INATIVA' ELSE 'ATIVA' END,
    TIMESTAMP '2024-02-01 00:00:00' + to_days(CAST(s.s_suppkey % 28 AS INT))
  FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
), cadastro AS (
  SELECT CAST(s_suppkey AS VARCHAR) AS icao, CAST(NULL AS VARCHAR) AS iata, nome AS razao_social,
    CASE WHEN n_regionkey = 1 THEN 'CNPJ-' || s_suppkey END AS cnpj,
    CASE WHEN n_regionkey = 1 THEN 'REGULAR' ELSE 'CARGA' END AS servico, n_name AS cidade,
    CAST(n_regionkey AS VARCHAR) AS uf, '' AS cep, '' AS telefone, '' AS email, situacao, '' AS decisao_operacional,
    '' AS data_decisao_operacional, CASE WHEN n_regionkey = 1 THEN '' END AS validade_operacional,
    CASE WHEN n_regionkey = 1 THEN CAST(copia AS VARCHAR) END AS id_empresa_aerea,
    CASE WHEN n_regionkey = 1 THEN '' ELSE CAST(copia AS VARCHAR) END AS endereco_sede,
    CASE WHEN n_regionkey = 1 THEN 'nacional' ELSE 'estrangeira' END AS origem_cadastro,
    CASE WHEN n_regionkey = 1 THEN 'nacionais' ELSE 'estrangeiras' END AS origem_arquivo, quando AS transformado_em
  FROM copias
), cabecalhos AS (
  SELECT 'icao' AS icao, 'iata' AS iata, 'razao_social' AS razao_social, 'cnpj' AS cnpj, 'atividades_aereas' AS servico,
    'cidade' AS cidade, 'uf' AS uf, 'cep' AS cep, 'telefone' AS telefone, 'email' AS email, 'situacao' AS situacao,
    'decisao_operacional' AS decisao_operacional, 'data_decisao_operacional' AS data_decisao_operacional,
    'validade_operacional' AS validade_operacional, 'id_empresa_aerea' AS id_empresa_aerea, 'endereco_sede' AS endereco_sede,
    'nacional' AS origem_cadastro, 'nacionais' AS origem_arquivo, TIMESTAMP '2024-01-01 00:00:00' AS transformado_em
  FROM nation
), empresas AS (
  SELECT * FROM cadastro UNION ALL SELECT * FROM cabecalhos
), dim_empresa AS (
  SELECT row_number() OVER (ORDER BY icao) AS sk_empresa, icao, iata, razao_social, cnpj, servico, cidade, uf, situacao,
    decisao_operacional, validade_operacional, origem_cadastro, coalesce(situacao, '') = 'ATIVA' AS flag_ativa
  FROM (SELECT *, row_number() OVER (PARTITION BY icao ORDER BY
          CASE WHEN razao_social <> '' THEN 0 ELSE 1 END, CASE WHEN situacao <> '' THEN 0 ELSE 1 END, transformado_em DESC) AS rn
        FROM cadastro) WHERE rn = 1
), dim_aerodromo AS (
  SELECT row_number() OVER (ORDER BY CAST(icao AS VARCHAR)) AS sk_aerodromo, CAST(icao AS VARCHAR) AS icao, 'C' || icao AS ciad, nome,
    municipio, estado AS uf_nome, '' AS municipio_servido, '' AS uf_servido_nome,
    CAST((icao * 10) || '.' || (icao % 10) AS DOUBLE) AS altitude_m, round(latitude, 1) AS latitude, round(longitude, 1) AS longitude,
    CASE WHEN icao % 6 = 0 THEN 'Interditado' WHEN icao % 6 = 1 THEN 'Descadastrado' ELSE 'Cadastrado' END AS situacao,
    'VFR' AS operacao_diurna, '' AS operacao_noturna,
    CASE WHEN icao % 6 = 0 THEN 'interditado' WHEN icao % 6 = 1 THEN 'outro' ELSE 'cadastrado' END AS status_operacional,
    latitude IS NOT NULL AS tem_coordenadas
  FROM aerodromo
), dim_tempo AS (
  SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INT) AS sk_tempo, d AS data, CAST(year(d) AS INT) AS ano,
    CAST(month(d) AS INT) AS mes, strftime(d, '%B') AS nome_mes, CAST(day(d) AS INT) AS dia, CAST(dayofweek(d) + 1 AS INT) AS dia_semana_num,
    strftime(d, '%A') AS nome_dia_semana, CAST(quarter(d) AS INT) AS trimestre, strftime(d, '%Y-%m') AS ano_mes,
    dayofweek(d) IN (0, 6) AS fim_de_semana,
    CASE WHEN month(d) IN (12, 1, 2) THEN 'verao' WHEN month(d) IN (3, 4, 5) THEN 'outono'
         WHEN month(d) IN (6, 7, 8) THEN 'inverno' ELSE 'primavera' END AS estacao
  FROM (SELECT CAST(unnest(generate_series(min(partida_prevista_data), max(partida_prevista_data), INTERVAL 1 DAY)) AS DATE) AS d FROM voos)
), dim_tipo_linha AS (
  SELECT row_number() OVER (ORDER BY codigo) AS sk_tipo_linha, codigo, CASE codigo WHEN 'N' THEN 'Nacional' ELSE 'Outro' END AS descricao
  FROM (SELECT DISTINCT codigo_tipo_linha AS codigo FROM voos)
), dim_situacao AS (
  SELECT row_number() OVER (ORDER BY codigo) AS sk_situacao, codigo,
    CASE codigo WHEN 'REALIZADO' THEN 'Voo realizado normalmente' ELSE 'Voo cancelado' END AS descricao,
    codigo = 'REALIZADO' AS flag_realizado, codigo = 'CANCELADO' AS flag_cancelado
  FROM (SELECT DISTINCT situacao_voo AS codigo FROM voos)
), dim_rota AS (
  SELECT row_number() OVER (ORDER BY CAST(icao_origem AS VARCHAR), CAST(icao_destino AS VARCHAR)) AS sk_rota,
    CAST(icao_origem AS VARCHAR) AS icao_origem, CAST(icao_destino AS VARCHAR) AS icao_destino,
    round(la, 1) AS lat_origem, round(lo, 1) AS lon_origem, round(lb, 1) AS lat_destino, round(lp, 1) AS lon_destino, distancia_km,
    CASE WHEN la IS NOT NULL AND lb IS NOT NULL THEN 'com_coordenadas' ELSE 'sem_coordenadas' END AS status_distancia
  FROM rota1
), fato AS (
  SELECT coalesce(e.sk_empresa, 0) AS sk_empresa, coalesce(ao.sk_aerodromo, 0) AS sk_aerodromo_origem,
    coalesce(ad.sk_aerodromo, 0) AS sk_aerodromo_destino, coalesce(t.sk_tempo, 0) AS sk_tempo_partida_prevista,
    coalesce(tr.sk_tempo, 0) AS sk_tempo_partida_real, coalesce(tl.sk_tipo_linha, 0) AS sk_tipo_linha,
    coalesce(s.sk_situacao, 0) AS sk_situacao, coalesce(r.sk_rota, 0) AS sk_rota,
    CAST(v.icao_empresa AS VARCHAR) AS icao_empresa, CAST(v.numero_voo AS VARCHAR) AS numero_voo, v.codigo_di,
    CAST(v.icao_origem AS VARCHAR) AS icao_origem, CAST(v.icao_destino AS VARCHAR) AS icao_destino,
    v.partida_prevista_hora, v.partida_real_hora, v.chegada_prevista_hora, v.chegada_real_hora, v.atraso_partida_min,
    v.atraso_chegada_min, v.minutos_recuperados, v.flag_realizado, v.flag_cancelado, v.partida_pontual, v.chegada_pontual,
    v.partida_atrasada, v.partida_atraso_severo, v.duracao_voo_min, v.periodo_partida, v.situacao_voo,
    v.codigo_justificativa, v.origem_arquivo, v.transformado_em, v.data_partida_prevista, v.pedido, v.item,
    row_number() OVER (ORDER BY v.data_partida_prevista NULLS FIRST, CAST(v.icao_empresa AS VARCHAR), CAST(v.numero_voo AS VARCHAR) NULLS FIRST, v.pedido, v.item) AS id_voo
  FROM linhas v
  LEFT JOIN dim_empresa e ON CAST(v.icao_empresa AS VARCHAR) = e.icao
  LEFT JOIN dim_aerodromo ao ON CAST(v.icao_origem AS VARCHAR) = ao.icao
  LEFT JOIN dim_aerodromo ad ON CAST(v.icao_destino AS VARCHAR) = ad.icao
  LEFT JOIN dim_tempo t ON v.partida_prevista_data = t.data LEFT JOIN dim_tempo tr ON v.partida_real_data = tr.data
  LEFT JOIN dim_tipo_linha tl ON v.codigo_tipo_linha = tl.codigo LEFT JOIN dim_situacao s ON v.situacao_voo = s.codigo
  LEFT JOIN dim_rota r ON CAST(v.icao_origem AS VARCHAR) = r.icao_origem AND CAST(v.icao_destino AS VARCHAR) = r.icao_destino
  WHERE v.icao_empresa IS NOT NULL
), obt AS (
  SELECT f.id_voo, f.icao_empresa, e.razao_social AS empresa_nome, e.iata AS empresa_iata, e.servico AS empresa_servico,
    e.origem_cadastro AS empresa_origem, e.situacao AS empresa_situacao, e.flag_ativa AS empresa_ativa,
    f.icao_origem, ao.nome AS origem_nome, ao.municipio AS origem_municipio, ao.uf_nome AS origem_uf,
    ao.latitude AS origem_latitude, ao.longitude AS origem_longitude, ao.status_operacional AS origem_status,
    f.icao_destino, ad.nome AS destino_nome, ad.municipio AS destino_municipio, ad.uf_nome AS destino_uf,
    ad.latitude AS destino_latitude, ad.longitude AS destino_longitude, ad.status_operacional AS destino_status,
    f.data_partida_prevista, t.ano, t.mes, t.nome_mes, t.dia, t.nome_dia_semana, t.trimestre, t.ano_mes, t.fim_de_semana,
    t.estacao, tl.codigo AS codigo_tipo_linha, tl.descricao AS tipo_linha, s.codigo AS codigo_situacao,
    s.descricao AS situacao_descricao, r.distancia_km AS rota_distancia_km,
    CASE WHEN r.distancia_km IS NULL THEN 'Sem coordenadas' WHEN r.distancia_km < 500 THEN 'Curta (<500km)'
         WHEN r.distancia_km < 1500 THEN 'Media (500-1500km)' WHEN r.distancia_km < 3000 THEN 'Longa (1500-3000km)'
         ELSE 'Extra-longa (>3000km)' END AS rota_faixa_distancia,
    f.numero_voo, f.codigo_di, f.partida_prevista_hora, f.partida_real_hora, f.chegada_prevista_hora, f.chegada_real_hora,
    f.atraso_partida_min, f.atraso_chegada_min, f.minutos_recuperados, f.duracao_voo_min, f.flag_realizado, f.flag_cancelado,
    f.partida_pontual, f.chegada_pontual, f.partida_atrasada, f.partida_atraso_severo, f.periodo_partida, f.situacao_voo,
    f.codigo_justificativa
  FROM fato f LEFT JOIN dim_empresa e ON f.sk_empresa = e.sk_empresa
  LEFT JOIN dim_aerodromo ao ON f.sk_aerodromo_origem = ao.sk_aerodromo
  LEFT JOIN dim_aerodromo ad ON f.sk_aerodromo_destino = ad.sk_aerodromo
  LEFT JOIN dim_tempo t ON f.sk_tempo_partida_prevista = t.sk_tempo LEFT JOIN dim_tipo_linha tl ON f.sk_tipo_linha = tl.sk_tipo_linha
  LEFT JOIN dim_situacao s ON f.sk_situacao = s.sk_situacao LEFT JOIN dim_rota r ON f.sk_rota = r.sk_rota
), brutos AS (
  SELECT CAST(icao_empresa AS VARCHAR) AS icao_empresa, CAST(numero_voo AS VARCHAR) AS numero_voo, codigo_di, codigo_tipo_linha,
    CAST(icao_origem AS VARCHAR) AS icao_origem, CAST(icao_destino AS VARCHAR) AS icao_destino,
    coalesce(strftime(partida_prevista_hora, '%Y-%m-%d %H:%M:%S'), 'null') AS partida_prevista,
    coalesce(strftime(partida_real_hora, '%Y-%m-%d %H:%M:%S'), 'null') AS partida_real,
    coalesce(strftime(chegada_prevista_hora, '%Y-%m-%d %H:%M:%S'), 'null') AS chegada_prevista,
    coalesce(strftime(chegada_real_hora, '%Y-%m-%d %H:%M:%S'), 'null') AS chegada_real,
    CASE WHEN pedido % 97 = 0 THEN NULL WHEN pedido % 89 = 0 THEN 'DESCONHECIDO' ELSE situacao_voo END AS situacao_voo,
    codigo_justificativa, origem_arquivo, transformado_em, pedido, item
  FROM voos
)
"""


def over_views(body: str) -> str:
    """A query that may use every view above."""
    return VIEWS + body
