"""Values that results depend on, in one place."""

from __future__ import annotations

from decimal import Decimal

# ---------------------------------------------------------------------------
# Fixed values. Business labels and thresholds; every operator takes them as
# parameters, these are the defaults.
# ---------------------------------------------------------------------------

# Day names by number, 1 = Sunday ... 7 = Saturday.
WEEKDAYS = {
    1: "Domingo",
    2: "Segunda",
    3: "Terça",
    4: "Quarta",
    5: "Quinta",
    6: "Sexta",
    7: "Sábado",
}

# Titles removed from the start of a customer name (title, dot, spaces).
TITLES = ["Sr", "Sra", "Srta", "Dr", "Dra"]

# Sales channels.
CHANNELS = ["ecommerce", "loja_fisica"]

# Product price bands: strictly above the amount.
PRICE_BANDS = [(Decimal("1000"), "PREMIUM"), (Decimal("500"), "MEDIO")]
LOWEST_PRICE_BAND = "BASICO"

# Customer segments: revenue from the amount on.
SEGMENTS = [(Decimal("22000"), "VIP"), (Decimal("17000"), "TOP_TIER")]
LOWEST_SEGMENT = "REGULAR"

# A competitor price below this share of our own price is suspicious.
SUSPICIOUS_SHARE = Decimal("0.6")

# Products watched at fewer competitors than this are under-covered.
MIN_COMPETITORS = 4

# Tolerated share of sales whose product is not in the catalog.
MAX_UNREGISTERED_SHARE = Decimal("0.01")

# Labels for a sale whose product is not in the catalog.
UNREGISTERED_PRODUCT = "Produto não cadastrado"
UNREGISTERED_GROUP = "Não cadastrado"

# Position of our price against the market.
DEARER_THAN_ALL = "MAIS_CARO_QUE_TODOS"
CHEAPER_THAN_ALL = "MAIS_BARATO_QUE_TODOS"
ABOVE_MEAN = "ACIMA_DA_MEDIA"
BELOW_MEAN = "ABAIXO_DA_MEDIA"
AT_MEAN = "NA_MEDIA"

# Severities of the quality scorecard.
ALERT = "ALERTA"
INFORMATIVE = "INFORMATIVO"
CORRECTED = "CORRIGIDO"

# Parts of the day: from the hour on.
DAY_PARTS = [(18, "noite"), (12, "tarde"), (6, "manha")]
FIRST_DAY_PART = "madrugada"

# States: code, name, region.
STATES = [
    ("AC", "Acre", "Norte"),
    ("AL", "Alagoas", "Nordeste"),
    ("AM", "Amazonas", "Norte"),
    ("AP", "Amapá", "Norte"),
    ("BA", "Bahia", "Nordeste"),
    ("CE", "Ceará", "Nordeste"),
    ("DF", "Distrito Federal", "Centro-Oeste"),
    ("ES", "Espírito Santo", "Sudeste"),
    ("GO", "Goiás", "Centro-Oeste"),
    ("MA", "Maranhão", "Nordeste"),
    ("MG", "Minas Gerais", "Sudeste"),
    ("MS", "Mato Grosso do Sul", "Centro-Oeste"),
    ("MT", "Mato Grosso", "Centro-Oeste"),
    ("PA", "Pará", "Norte"),
    ("PB", "Paraíba", "Nordeste"),
    ("PE", "Pernambuco", "Nordeste"),
    ("PI", "Piauí", "Nordeste"),
    ("PR", "Paraná", "Sul"),
    ("RJ", "Rio de Janeiro", "Sudeste"),
    ("RN", "Rio Grande do Norte", "Nordeste"),
    ("RO", "Rondônia", "Norte"),
    ("RR", "Roraima", "Norte"),
    ("RS", "Rio Grande do Sul", "Sul"),
    ("SC", "Santa Catarina", "Sul"),
    ("SE", "Sergipe", "Nordeste"),
    ("SP", "São Paulo", "Sudeste"),
    ("TO", "Tocantins", "Norte"),
]

# Column names of the Portuguese source tables and the names used here.
PORTUGUESE_COLUMNS = {
    "id_venda": "sale_id",
    "data_venda": "sold_at",
    "id_cliente": "customer_id",
    "id_produto": "product_id",
    "canal_venda": "channel",
    "quantidade": "quantity",
    "preco_unitario": "unit_price",
    "nome_produto": "product_name",
    "categoria": "category",
    "marca": "brand",
    "preco_atual": "list_price",
    "data_criacao": "created_at",
    "nome_cliente": "customer_name",
    "estado": "state",
    "pais": "country",
    "data_cadastro": "registered_at",
    "nome_concorrente": "competitor",
    "preco_concorrente": "competitor_price",
    "data_coleta": "collected_at",
    "sigla": "state",
    "nome": "state_name",
    "regiao_nome": "region",
}
