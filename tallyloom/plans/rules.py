"""Fixed values of the retail cleaners: word lists, groups, limits and code lists."""

from tallyloom.functions.text import CONNECTIVES

# Place-name aliases and markers of the customer cleaner.
CITY_ALIASES = {"bh": "Belo Horizonte", "rj": "Rio de Janeiro"}
CITY_MARKERS = {"quilometro 14": "Mutum", "km 14": "Mutum"}

# Abbreviations of the seller cleaner and of the "Unknown" default variant.
SELLER_ABBREVIATIONS = {"sp": "sao paulo"}
DEFAULT_ABBREVIATIONS = {"sp": "Sao Paulo"}

# Names written correctly as they stand, once in title case.
CITY_NAMES = (
    "sao paulo", "rio de janeiro", "belo horizonte", "brasilia", "curitiba", "fortaleza",
    "salvador", "porto alegre", "guarulhos", "campinas", "sao bernardo do campo", "santo andre",
    "osasco", "jundiai", "sao caetano do sul", "mogi das cruzes", "taboao da serra",
    "itapecerica da serra", "santana de parnaiba", "goiania", "nova iguacu", "ribeirao preto",
    "ribeirao das neves", "ribeirao pires", "niteroi", "sao joao de meriti",
    "sao jose dos campos", "sao jose do rio preto", "feira de santana", "varzea grande",
    "sao vicente", "jaboatao dos guararapes", "aparecida de goiania", "vitoria da conquista",
    "barueri", "cotia", "carapicuiba", "diadema", "suzano", "embu das artes",
)


def _title(name: str) -> str:
    words = name.split()
    return " ".join(w if i and w in CONNECTIVES else w.capitalize() for i, w in enumerate(words))


# One name is corrected to another; the rest only gain their capitals.
CITY_CORRECTIONS = {**{name: _title(name) for name in CITY_NAMES}, "embu": "Embu das Artes"}

# State codes, and the region each state belongs to.
REGION_STATES = {
    "Southeast": ("SP", "RJ", "MG", "ES"),
    "South": ("PR", "RS", "SC"),
    "Central-West": ("MT", "MS", "GO", "DF"),
    "Northeast": ("BA", "PE", "CE", "PB", "MA", "RN", "AL", "PI", "SE"),
    "North": ("PA", "AM", "RO", "AP", "AC", "RR", "TO"),
}
STATE_CODES = tuple(code for states in REGION_STATES.values() for code in states)

# Metropolitan areas by seller city.
METRO_CITIES = {
    "Sao Paulo Metro": ("Sao Paulo", "Guarulhos", "Santo Andre", "Osasco", "Barueri"),
    "Rio Metro": ("Rio De Janeiro", "Niteroi", "Nova Iguacu", "Duque De Caxias"),
    "BH Metro": ("Belo Horizonte", "Contagem", "Betim"),
    "Curitiba Metro": ("Curitiba", "Sao Jose Dos Pinhais", "Colombo"),
    "Porto Alegre Metro": ("Porto Alegre", "Canoas", "Novo Hamburgo"),
}
NEAR_MARKET_STATES = ("SP", "RJ", "MG")

# Lower bounds of the seller count classes.
CITY_SIZE_STEPS = ((500, "Major City"), (100, "Large City"), (50, "Medium City"))
CITY_SIZE_LAST = "Small City"
DENSITY_STEPS = ((100, "High"), (20, "Medium"))
DENSITY_LAST = "Low"

# Product category groups.
CATEGORY_GROUPS = {
    "Home & Decor": (
        "bed bath table", "furniture decor", "home construction", "housewares",
        "office furniture", "furniture living room", "kitchen dining laundry garden furniture",
        "home comfort",
    ),
    "Health & Fashion": (
        "sports leisure", "health beauty", "fashion bags accessories", "fashion shoes",
        "fashion male clothing", "luggage accessories",
    ),
    "Electronics & Tech": (
        "computers accessories", "telephony", "electronics", "pc gamer",
        "tablets printing image", "fixed telephony", "home appliances", "home appliances 2",
        "small appliances", "air conditioning",
    ),
    "Kids & Baby": ("toys", "baby", "fashion children clothes"),
    "Gifts & Personal": ("watches gifts", "perfumery", "art", "christmas articles"),
    "Food & Beverage": ("food", "drinks", "food drink"),
    "Tools & Construction": (
        "garden tools", "construction tools construction", "construction tools garden",
        "construction tools safety", "construction tools lights",
    ),
}

# Plural heuristic.
PLURAL_ENDINGS = ("is", "es", "ns")
SINGULAR_WORDS = ("business", "press", "express")
PLURAL_WORDS = ("alimentos", "bebes", "artes", "housewares", "supplies", "clothes")

# Pairs of names that agree in number although the heuristic says otherwise.
# Each row: pattern for the original name, pattern for the English one (SQL LIKE; None = any).
PLURAL_PAIR_PATTERNS = (
    ("%ferramentas%", "%tools%"),
    (None, "%supplies%"),
    (None, "%clothes%"),
    ("%livros_%", "books_%"),
    ("%comercio%", "%commerce%"),
    ("%negocios%", "%business%"),
)
PLURAL_PAIR_NAMES = (
    ("alimentos_bebidas", "bebes", "artes", "alimentos"),
    ("food_drink", "baby", "art", "food"),
)

# Original names (SQL LIKE) with the wording to compare; the first match counts.
# The third field lists words to exchange in place; without it the whole name is replaced.
NAME_RULES = (
    ("%portateis_casa_forno_e_cafe%", "small_appliances_home_oven_and_coffee", None),
    ("%fashion_roupa_infanto_juvenil%", "fashion_childrens_clothes", None),
    ("%utilidades_domesticas%", "housewares", None),
    ("%instrumentos_musicais%", "musical_instruments", None),
    ("%livros_interesse_geral%", "books_general_interest", None),
    ("%moveis_cozinha_area_de_servico_jantar_e_jardim%", "kitchen_dining_laundry_garden_furniture", None),
    ("%moveis_colchao_e_estofado%", "furniture_mattress_and_upholstery", None),
    ("%moveis%", None, {"moveis": "furniture"}),
    ("%construcao_ferramentas_ferramentas%", "construction_tools_tools", None),
    ("%construcao_ferramentas%", None, {"construcao": "construction", "ferramentas": "tools"}),
)
ENGLISH_TYPOS = {"costruction": "construction"}
NEAR_NAMES = (
    "portateis_casa_forno_e_cafe", "fashion_roupa_infanto_juvenil", "utilidades_domesticas",
    "instrumentos_musicais", "livros_interesse_geral",
)
NEAR_DISTANCE = 5
DISSIMILAR_ABOVE = 15

# Stock review phrases and words left over from translation.
GENERIC_RESPONSES = (
    "tudo ok", "recebi bem antes do prazo", "produto muito bom", "chegou antes do prazo",
    "otimo produto", "recomendo", "excelente",
)
WORD_CORRECTIONS = {
    "timo": "great",
    "rpido": "fast",
    "otima": "excellent",
    "j t": "already",
    "jt": "already",
}

# Code lists and limits of the schema constraints.
ORDER_STATUSES = (
    "approved", "canceled", "created", "delivered", "invoiced", "processing", "shipped",
    "unavailable",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
SHIPPING_WINDOW = ("2016-01-01", "2018-12-31")
ID_LENGTH = 32
ULTRA_LIGHT_GRAMS = 250
LONG_SIDE_CM = 100
OUTLIER_SIGMAS = 3
