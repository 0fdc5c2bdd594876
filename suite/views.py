"""Input views over the given tables, in SQL both Spark and DuckDB run unchanged."""

from __future__ import annotations

VIEWS = {
    "f1_bars": """
        SELECT l_returnflag AS ticker, CAST(l_shipdate AS DATE) AS date,
          MAX(l_extendedprice / l_quantity) AS high,
          MIN(l_extendedprice / l_quantity) AS low,
          ROUND(SUM(l_extendedprice), 2) / SUM(l_quantity) AS close,
          SUM(l_quantity) AS volume
        FROM lineitem GROUP BY l_returnflag, CAST(l_shipdate AS DATE)""",
    "f2_postings": """
        SELECT CONCAT(source, ':', CAST(doc_id AS STRING)) AS job_uid, doc_id, source,
          SPLIT_PART(text, CHR(10), 1) AS title,
          CONCAT('Company ', CAST(doc_id % 37 AS STRING)) AS company,
          lang AS market, text AS description,
          CASE WHEN doc_id % 13 = 0 THEN NULL
               ELSE DATE '2024-01-01' + CAST(doc_id % 120 AS INT) END AS published_date,
          DATE '2024-01-01' + CAST(doc_id % 120 + doc_id % 5 AS INT) AS first_seen_date
        FROM documents""",
    # postings whose titles exercise the taxonomies: a role phrase before the text's first line
    "f2_roles": """
        SELECT doc_id, source, lang, text,
          CONCAT(CASE doc_id % 24
            WHEN 0 THEN 'Senior Data Engineer' WHEN 1 THEN 'Lead Senior Analyst'
            WHEN 2 THEN 'Gerente de Produto' WHEN 3 THEN 'Headhunter'
            WHEN 4 THEN 'Analista de Dados Pleno' WHEN 5 THEN 'Analista I'
            WHEN 6 THEN 'Engineer II' WHEN 7 THEN 'Engineer III'
            WHEN 8 THEN 'ENGENHEIRO SÊNIOR' WHEN 9 THEN 'Estágio em TI'
            WHEN 10 THEN 'International Account Executive' WHEN 11 THEN 'Data Analyst'
            WHEN 12 THEN 'Backend Developer (Java)' WHEN 13 THEN 'Product Designer'
            WHEN 14 THEN 'UX Designer' WHEN 15 THEN 'Customer Success Manager'
            WHEN 16 THEN 'Growth Marketing' WHEN 17 THEN 'Receptionist'
            WHEN 18 THEN 'Remote Jr. Engineer 2' WHEN 19 THEN 'Analista de BI / Power BI'
            WHEN 20 THEN '.NET developer' WHEN 21 THEN 'Talent Partner, People Ops'
            WHEN 22 THEN 'VP Finance' ELSE 'Suporte Home Office' END,
            CASE WHEN doc_id % 5 = 0 THEN CONCAT(' - ', SPLIT_PART(text, CHR(10), 1))
                 ELSE '' END) AS title,
          CASE doc_id % 6 WHEN 0 THEN 'Ação S.A.' WHEN 1 THEN 'Acme' WHEN 2 THEN 'Müller & Söhne'
            WHEN 3 THEN 'Pleno Sistemas' WHEN 4 THEN '' ELSE CONCAT('Company ', CAST(doc_id % 37 AS STRING)) END AS company,
          CASE doc_id % 7 WHEN 0 THEN 'São Paulo, Remote' WHEN 1 THEN 'Brasília' WHEN 2 THEN 'Remote - US'
            WHEN 3 THEN 'Berlin' WHEN 4 THEN 'Híbrido, Curitiba' WHEN 5 THEN 'Presencial' ELSE '' END AS location,
          CASE WHEN doc_id % 9 = 0 THEN 'Mid Level' WHEN doc_id % 9 = 1 THEN ' Management '
               WHEN doc_id % 9 = 2 THEN 'Unheard of' END AS level_hint,
          CASE WHEN doc_id % 11 = 0 THEN 'DevOps and Sysadmin' WHEN doc_id % 11 = 1 THEN 'Business'
               WHEN doc_id % 11 = 2 THEN 'Gardening' END AS category_hint
        FROM documents""",
    "f4_observations": """
        SELECT CAST(user_id AS STRING) AS uid, CAST(ts AS DATE) AS run_date, event_id AS seq,
          CAST(FLOOR(value / 10) AS INT) AS price
        FROM events""",
    "f5_listings": """
        SELECT 'portal' AS source, CAST(FLOOR((c_custkey + 1) / 2) AS BIGINT) AS native_id, c_custkey AS ord,
          n_name AS city, r_name AS state,
          CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN CAST(0 AS DOUBLE)
               ELSE CAST(-22.9099 AS DOUBLE) + CAST((c_custkey * 37) % 401 - 200 AS DOUBLE) / 80 END AS lat,
          CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN CAST(0 AS DOUBLE)
               ELSE CAST(-47.0626 AS DOUBLE) + CAST((c_custkey * 53) % 401 - 200 AS DOUBLE) / 80 END AS lon,
          CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE CAST(2000 + (c_custkey * 131) % 16000 AS INT) END AS rent,
          CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE CAST(50 + (c_custkey * 977) % 30000 AS INT) END AS total_area,
          CAST(1 + c_custkey % 6 AS INT) AS bedrooms, CAST(c_custkey % 9 AS INT) AS n_photos,
          CASE WHEN c_custkey % 2 = 0 THEN 'A' ELSE 'B' END AS portal
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    # texts a property classifier meets: a phrase by key before a real text
    "f5_texts": """
        SELECT doc_id,
          CASE doc_id % 8 WHEN 0 THEN 'Sítio em Atibaia' WHEN 1 THEN 'Fazenda e haras'
            WHEN 2 THEN 'Rancho beira rio' WHEN 3 THEN 'Chácara com área verde'
            WHEN 4 THEN 'Terreno 5.000m²' WHEN 5 THEN 'Linda casa com piscina e lareira'
            WHEN 6 THEN 'Casa' ELSE 'GLEBA à venda' END AS title,
          CASE doc_id % 5 WHEN 0 THEN 'FARM' WHEN 1 THEN 'HOME' WHEN 2 THEN 'XYZ'
            WHEN 3 THEN 'allotment_land' END AS unit_type,
          CONCAT(CASE doc_id % 6 WHEN 0 THEN 'Tem poço artesiano, açude e pomar. '
            WHEN 1 THEN 'Condomínio fechado, fibra óptica, churrasqueira. '
            WHEN 2 THEN 'Casa de caseiro, baias, placas solares, heliponto. '
            WHEN 3 THEN 'Semi-mobiliada, quadra de tênis, wi-fi. ' ELSE '' END, text) AS description,
          CASE doc_id % 4 WHEN 0 THEN 'POOL' WHEN 1 THEN 'air_conditioning' WHEN 2 THEN 'BIKE_RACK' END AS amenity_1,
          CASE doc_id % 3 WHEN 0 THEN 'LAKE' WHEN 1 THEN 'PARTY_HALL' END AS amenity_2
        FROM documents""",
    "f7_products": """
        SELECT p_partkey AS product_id, p_name AS name, p_type AS category,
          CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_retailprice END AS price FROM part""",
    "f7_variants": """
        SELECT product_id, variant, CASE WHEN (product_id + variant) % 5 = 0 THEN NULL ELSE price + variant * 10 END AS variant_price
        FROM (SELECT p_partkey AS product_id, 1 AS variant, p_retailprice AS price FROM part WHERE p_partkey % 4 >= 1
          UNION ALL SELECT p_partkey, 2, p_retailprice FROM part WHERE p_partkey % 4 >= 2
          UNION ALL SELECT p_partkey, 3, p_retailprice FROM part WHERE p_partkey % 4 >= 3)""",
    "f7_cart": """
        SELECT l_orderkey AS basket, l_partkey AS product_id,
          CAST(l_linenumber % 4 AS INT) AS variant, l_quantity AS qty FROM lineitem""",
    "f8_leads": """
        SELECT c_custkey AS business_id,
          c_custkey % 3 <> 0 AS has_website, c_custkey % 4 <> 0 AS has_phone,
          CAST(10 + (c_custkey * 7) % 41 AS DOUBLE) / 10 AS rating,
          CAST(COUNT(o_orderkey) * 6 AS BIGINT) AS reviews
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
    "f9_facets": """
        SELECT o_orderkey AS id, o_orderpriority AS source, c_mktsegment AS area,
          o_orderstatus AS seniority, r_name AS work_model, n_name AS market, c_name AS company,
          CAST(o_orderdate AS DATE) AS pub
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
}

TABLES_OF = {
    "f1_bars": ("lineitem",),
    "f2_postings": ("documents",),
    "f2_roles": ("documents",),
    "f4_observations": ("events",),
    "f5_listings": ("customer", "nation", "region"),
    "f5_texts": ("documents",),
    "f7_products": ("part",),
    "f7_variants": ("part",),
    "f7_cart": ("lineitem",),
    "f8_leads": ("customer", "orders"),
    "f9_facets": ("orders", "customer", "nation", "region"),
}

# Parameters of the market queries on f1_bars.
PAIR = ("A", "R")
WARN, BREACH = 6.5, 10.0

# DuckDB twins of derived tables several oracles start from.
CTES = VIEWS | {
    "f1_ret": """
        SELECT *, close / LAG(close) OVER (PARTITION BY ticker ORDER BY date) - 1 AS ret
        FROM f1_bars""",
    "f1_rolled": """
        SELECT *, ret * 100 AS ret_pct,
          CASE WHEN COUNT(ret) OVER m = 21 THEN STDDEV_SAMP(ret) OVER m * SQRT(252) END AS vol_21d,
          close / MAX(close) OVER (PARTITION BY ticker ORDER BY date) - 1 AS drawdown,
          CASE WHEN COUNT(close) OVER y >= 20 THEN MAX(close) OVER y END AS high_52w,
          CASE WHEN COUNT(close) OVER y >= 20 THEN MIN(close) OVER y END AS low_52w,
          CASE WHEN COUNT(close) OVER s = 50 THEN AVG(close) OVER s END AS ma50,
          CASE WHEN COUNT(close) OVER l = 200 THEN AVG(close) OVER l END AS ma200
        FROM f1_ret
        WINDOW m AS (PARTITION BY ticker ORDER BY date ROWS 20 PRECEDING),
               y AS (PARTITION BY ticker ORDER BY date ROWS 251 PRECEDING),
               s AS (PARTITION BY ticker ORDER BY date ROWS 49 PRECEDING),
               l AS (PARTITION BY ticker ORDER BY date ROWS 199 PRECEDING)""",
    "f1_metrics": f"""
        SELECT *, close / high_52w - 1 AS pct_from_high,
          CASE WHEN vol_21d >= {BREACH} THEN 'BREACH' WHEN vol_21d >= {WARN} THEN 'WARN'
               ELSE 'OK' END AS risk_flag
        FROM f1_rolled""",
    "f1_joint": """
        SELECT date, MAX(ret) FILTER (WHERE ticker = 'A') AS a, MAX(ret) FILTER (WHERE ticker = 'R') AS b
        FROM f1_ret WHERE ticker IN ('A', 'R') GROUP BY date""",
    "f1_corr": """
        SELECT date, corr_63d FROM (
          SELECT date, CASE WHEN COUNT(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN 1 END) OVER w = 63
                            THEN CORR(a, b) OVER w END AS corr_63d
          FROM f1_joint WINDOW w AS (ORDER BY date ROWS 62 PRECEDING)) WHERE corr_63d IS NOT NULL""",
    "f1_stats": """
        SELECT AVG(a) * 252 AS mean_a, AVG(b) * 252 AS mean_b,
          STDDEV_SAMP(a) * SQRT(252) AS risk_a, STDDEV_SAMP(b) * SQRT(252) AS risk_b, CORR(a, b) AS rho
        FROM f1_joint WHERE a IS NOT NULL AND b IS NOT NULL""",
}
