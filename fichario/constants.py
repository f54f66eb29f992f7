"""Fixed values of the domain: code lists, word lists, patterns and labels.

Everything here is data that results depend on literally. Nothing in this module is logic.
"""

# Registry status of an active branch.
ACTIVE_STATUS = "02"

# The 18 retail activity codes.
RETAIL_CNAES = (
    "4791201", "4781400", "4782201", "4782202", "4783101", "4783102",
    "4772500", "4763601", "4763602", "4755503", "4754701", "4753900",
    "4751201", "4752100", "4789001", "4759899", "4530703", "4744099",
)

# Partner qualification codes that mark an administrator.
ADMIN_QUALIFICATIONS = ("05", "16", "17", "49")

# Population floor of the retail view and the completeness check of a population load.
LARGE_CITY = 100_000
COMPLETE_POPULATION_ROWS = 5_500

# E-mail domains that never identify a company.
FREE_EMAIL_DOMAINS = (
    "gmail.com", "googlemail.com", "hotmail.com", "outlook.com", "outlook.com.br", "live.com",
    "yahoo.com", "yahoo.com.br", "yahoo.com.ar", "uol.com.br", "terra.com.br", "bol.com.br",
    "icloud.com", "proton.me", "protonmail.com", "ig.com.br", "msn.com", "ymail.com",
)

# Local-part words of role mailboxes.
ACCOUNTING_PREFIXES = (
    "fiscal", "financeiro", "contabilidade", "contador", "nfe", "faturamento", "dp", "rh",
)
FINANCE_WORDS = ("financeiro", "fiscal", "nfe")
SALES_WORDS = ("contato", "atendimento", "vendas", "comercial", "sales", "sac")
SUPPORT_WORDS = ("suporte", "support", "help")

# Brazilian area codes.
AREA_CODES = (
    "11", "12", "13", "14", "15", "16", "17", "18", "19", "21", "22", "24", "27", "28",
    "31", "32", "33", "34", "35", "37", "38", "41", "42", "43", "44", "45", "46", "47", "48", "49",
    "51", "53", "54", "55", "61", "62", "63", "64", "65", "66", "67", "68", "69",
    "71", "73", "74", "75", "77", "79", "81", "82", "83", "84", "85", "86", "87", "88", "89",
    "91", "92", "93", "94", "95", "96", "97", "98", "99",
)

# Link fragments that mark a WhatsApp link.
WHATSAPP_TOKENS = ("wa.me/", "api.whatsapp.com/", "web.whatsapp.com/", "whatsapp://")

# Shop platforms and the patterns that reveal each (searched without case).
PLATFORM_PATTERNS = {
    "shopify": [r"cdn\.shopify\.com", r"Shopify\.theme", r"myshopify\.com", r"shopify-section"],
    "nuvemshop": [r"nuvemshop", r"tiendanube", r"lojavirtualnuvem", r"mitiendanube"],
    "tray": [r"tray\.com\.br", r"traycdn", r"traycorp"],
    "vtex": [r"vtexassets", r"vteximg", r"__vtex", r"vtexcommercestable", r"vtex\.com"],
    "woocommerce": [
        r"woocommerce", r"wp-content/plugins/woocommerce", r"/wc-api/", r"add-to-cart",
    ],
    "loja_integrada": [r"lojaintegrada\.com\.br", r"cdn\.lojaintegrada", r"instaclose"],
    "magento": [r"Mage\.Cookies", r"/static/version", r"magento", r"data-mage-init"],
    "wake": [r"wake\.com\.br", r"cdn\.wake", r"wakecommerce"],
    "dooca": [r"dooca", r"doocacommerce", r"dcstore"],
    "bagy": [r"bagy\.com\.br", r"cdn\.bagy"],
    "opencart": [r"route=product/product", r"catalog/view/theme", r"index\.php\?route="],
    "prestashop": [r"prestashop", r"/modules/ps_", r"var prestashop"],
    "wix_stores": [r"wixstores", r"wix-ecommerce", r"static\.wixstatic\.com"],
    "squarespace_commerce": [
        r"squarespace\.com", r"static1\.squarespace", r"commerce.squarespace",
    ],
}

# Chat widgets in order of precedence, and the generic widget pattern.
CHAT_PATTERNS = {
    "blip": [r"blip\.chat", r"take\.net/blip"],
    "zenvia": [r"zenvia", r"totalvoice"],
    "jivochat": [r"jivosite", r"jivo\.chat"],
    "tawk": [r"tawk\.to"],
    "zendesk": [r"static\.zdassets", r"zendesk"],
    "intercom": [r"intercomcdn", r"intercom\.io"],
    "crisp": [r"client\.crisp\.chat"],
    "hubspot": [r"js\.hs-scripts", r"hubspot"],
    "drift": [r"js\.driftt\.com"],
    "livechat": [r"livechatinc\.com"],
    "freshchat": [r"freshchat", r"wchat\.freshchat"],
}
GENERIC_CHAT_WORDS = ("chat-widget", "live-chat", "open-chat", "btn-chat")

# Words that announce a site not yet open.
COMING_SOON_WORDS = (
    "em breve", "coming soon", "under construction", "loja em construção", "site em manutenção",
)

# Words searched in lower-cased pages, one list per commerce flag.
PRODUCT_PAGE_PATTERN = r"/produto/|/products/|/product/|/p/\d"
ADD_TO_CART_WORDS = (
    "add-to-cart", "adicionar ao carrinho", "comprar agora", "buy now", "btn-comprar",
)
CART_WORDS = ("/cart", "/carrinho", "minicart", "shopping-cart")
CHECKOUT_WORDS = ("/checkout", "finalizar compra", "checkout-button", "place-order")
CATALOG_WORDS = ("/categor", "/catalog", "product-grid", "grade-produtos", "lista-produtos")
SEARCH_WORDS = ('type="search"', 'name="q"', "buscar produto", "search-form")
LOGIN_WORDS = ("login", "minha conta", "customer/account", "entrar")
CONTACT_FORM_PATTERN = r"<form[^>]+(contato|contact|fale conosco)"

# Inner paths visited after the landing page, in visit order.
INNER_PATHS = (
    "/produtos", "/produto", "/loja", "/shop", "/catalogo", "/categorias", "/carrinho",
    "/cart", "/checkout", "/contato", "/products", "/product", "/p/",
)

# Title words that contradict a retail business (compared after normalisation).
INCOMPATIBLE_TITLES = (
    "contabil", "contador", "contabilidade", "escritorio cont", "provedor", "hosting", "dominio",
    "registro.br", "em breve", "coming soon", "under construction", "parked domain",
    "dominio estacionado",
)

# Social networks that are not a company's own site.
SOCIAL_HOSTS = (
    "instagram.com", "facebook.com", "linkedin.com", "twitter.com", "x.com", "youtube.com",
)

# Legal-form suffixes removed from names.
LEGAL_SUFFIX_PATTERN = (
    r"\b(ltda|ltda\.|me|epp|eireli|sa|s\.a\.|s/a|limitada|microempresa)\b"
)

# IPv4 blocks that a fetched URL must not point to (loopback, private, link-local,
# multicast, reserved), and the two addresses inside them that are public.
BLOCKED_IPV4 = (
    "0.0.0.0/8", "10.0.0.0/8", "127.0.0.0/8", "169.254.0.0/16", "172.16.0.0/12",
    "192.0.0.0/24", "192.0.2.0/24", "192.168.0.0/16", "198.18.0.0/15", "198.51.100.0/24",
    "203.0.113.0/24", "224.0.0.0/4", "240.0.0.0/4",
)
PUBLIC_IPV4 = ("192.0.0.9", "192.0.0.10")

# Size-band labels.
BAND_MEI = "faixa cadastral MEI (Receita/Simples)"
BAND_BY_PORTE = {
    "01": "faixa cadastral Microempresa (Receita)",
    "03": "faixa cadastral EPP (Receita)",
    "05": "faixa cadastral Demais portes (Receita)",
}
BAND_SIMPLES = "Simples Nacional (faixa cadastral, não é faturamento)"
BAND_CAPITAL_HIGH = "capital social cadastral elevado (proxy, não faturamento)"
BAND_CAPITAL_MEDIUM = "capital social cadastral médio-alto (proxy)"
BAND_UNKNOWN = "porte/faturamento não estimados (apenas cadastro)"
BAND_SOURCE_REGISTRY = "heuristica_porte_receita"
BAND_SOURCE_CAPITAL = "heuristica_capital_cadastral"
BAND_SOURCE_LOCAL = "heuristica_local"

# Versions and default settings of the enrichment and qualification jobs.
SCORE_VERSION = "v2"
ENRICHMENT_VERSION = "v2"
QUALIFICATION_VERSION = "v2"
SITE_MATCH_THRESHOLD = 70
PLACE_MATCH_THRESHOLD = 70
PLACE_TTL_DAYS = 90
NO_SITE_RETRY_DAYS = 30
FAILED_RETRY_HOURS = 24
MIN_CONFIDENCE = 60
MIN_LEAD = 60
