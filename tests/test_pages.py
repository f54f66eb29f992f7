import pytest
from pyspark.sql import functions as F

from fichario.functions import pages as P
from fichario.functions import urls
from fichario.operators import pages



def signals(spark, *htmls, url="https://loja.com.br/"):
    rows = spark.createDataFrame([(n, url, h) for n, h in enumerate(htmls)], "n int, url string, html string")
    return pages.page_signals(rows).orderBy("n").collect()


@pytest.mark.parametrize(
    "html, name, confidence",
    [
        ("cdn.shopify.com", "shopify", 45), ("window.__vtex = 1; vteximg", "vtex", 75),
        ("TIENDANUBE", "nuvemshop", 45), ("Mage.Cookies", "magento", 45),
        ("cdn.shopify.com myshopify.com Shopify.theme", "shopify", 95),
        ("commerceXsquarespace", "squarespace_commerce", 45), ("cdnXshopifyXcom", None, 0),
    ],
)
def test_platforms(spark, html, name, confidence):
    row = signals(spark, html)[0]
    assert (row.plataforma, row.plataforma_confianca) == (name, confidence)


def test_platform_order(spark):
    row = signals(spark, "wake.com.br magento Mage.Cookies dooca")[0]
    assert row.plataformas_detectadas == ["magento", "wake", "dooca"]


def test_commerce_flags(spark):
    shop, checkout, form, price, none, soon, written, ld = signals(
        spark,
        '<script type="application/ld+json">{"@type": "Product"}</script><b>add-to-cart</b><a href="/cart">',
        '<a href="/checkout">',
        '<FORM action="/x" class="contato">',
        '<div class="big Product x">\n\n<b>PREÇO</b></div>',
        '<b>preço</b><div class="product">',
        "Em Breve: LOJA EM CONSTRUÇÃO",
        "por R$ 1.234,50",
        '<script type="APPLICATION/LD+JSON">x Product</script>',
    )
    assert shop.has_product_schema and shop.has_add_to_cart and shop.has_cart
    assert not shop.has_checkout and checkout.has_checkout
    assert form.has_contact_form and price.has_price and not none.has_price
    assert soon.coming_soon and written.has_price and ld.has_product_schema


def test_chat(spark):
    rows = signals(spark, "code.tawk.to zendesk", "live-chat", "nada", "Blip.Chat")
    assert [r.chat_provider for r in rows] == ["tawk", "custom", None, "blip"]
    assert [r.has_chat for r in rows] == [True, True, False, True]


def anchor(link):
    return f'<a class="x" HREF="{link}">'


@pytest.mark.parametrize(
    "link, detected, normalized",
    [
        ("https://wa.me/5511999998888", True, "5511999998888"),
        ("https://api.whatsapp.com/send?phone=5511988887777&text=Oi", True, "5511988887777"),
        ("https://web.whatsapp.com/send?phone=5521987654321", True, "5521987654321"),
        ("https://api.whatsapp.com/send?text=a&Phone=%2B5511988887777", True, "5511988887777"),
        ("whatsapp://send?phone=11988887777", True, "5511988887777"),
        ("https://api.whatsapp.com/send", True, None), ("https://wa.me/123", True, None),
        ("https://loja.com.br/", False, None), ("https://wa.me/5511999998888?text=1", True, "5511999998888"),
        ("https://api.whatsapp.com/send?phone=100%zz", True, None),
    ],
)
def test_whatsapp_link(spark, link, detected, normalized):
    row = signals(spark, anchor(link))[0].whatsapp
    assert (row.detected, row.valid, row.normalized) == (detected, normalized is not None, normalized)
    assert row.confidence == (90 if normalized else 10 if detected else 0)


def test_first_valid_whatsapp_wins(spark):
    html = anchor("https://api.whatsapp.com/send") + anchor("https://wa.me/5511999998888") + anchor(
        "https://wa.me/5541999998888")
    assert signals(spark, html)[0].whatsapp.normalized == "5511999998888"


def test_social_links(spark):
    rows = signals(
        spark,
        anchor("https://www.Instagram.com/loja?igsh=1") + anchor("//linkedin.com/company/x"),
        anchor("/instagram.com/y"), "<p>",
    )
    assert [r.instagram_url for r in rows] == [
        "https://www.Instagram.com/loja", "https://loja.com.br/instagram.com/y", None]
    assert rows[0].linkedin_url == "https://linkedin.com/company/x"


def test_title(apply):
    given = ["<title> Loja </title>", "<TITLE lang=x>a</TITLE><title>b</title>", "<title></title>", "x",
             "<title>" + "a" * 201 + "</title>"]
    assert apply(P.title, given) == ["Loja", "a", "", "", ""]


def test_hosts(apply):
    given = ["https://WWW.Loja.com.br:8080/x", "http://u:p@a.com/", "https://[::1]/", "nada", "http://www.www.a.com?x"]
    assert apply(urls.site_host, given) == ["loja.com.br", "a.com", "::1", None, "www.a.com"]


@pytest.mark.parametrize(
    "url, reason",
    [
        ("http://127.0.0.1/", "localhost"), ("http://127.0.0.2/", "ip_bloqueado:127.0.0.2"),
        ("ftp://a.com", "scheme_invalido"), ("http://u:p@a.com/", "credenciais_na_url"),
        ("http://", "host_ausente"), ("http://LOCALHOST:80", "localhost"),
        ("http://10.1.2.3", "ip_bloqueado:10.1.2.3"), ("http://172.32.0.1", None),
        ("http://172.31.0.1", "ip_bloqueado:172.31.0.1"), ("http://8.8.8.8/", None),
        ("http://2130706433/", "ip_bloqueado:127.0.0.1"), ("http://0x7f.1/", "ip_bloqueado:127.0.0.1"),
        ("http://0177.0.0.1/", "ip_bloqueado:127.0.0.1"), ("http://192.0.0.9/", None),
        ("http://[::1]/", "ip_bloqueado:::1"), ("http://[fe80::1]/", "ip_bloqueado:fe80::1"),
        ("http://[2800:3f0::1]/", None), ("https://loja.com.br/", None),
        ("http://169.254.169.254/x", "ip_bloqueado:169.254.169.254"), ("http://256.1.1.1/", None),
    ],
)
def test_unsafe_urls(spark, url, reason):
    rows = spark.createDataFrame([(url,)], "url string")
    assert urls.flag_unsafe(rows).first().unsafe_reason == reason


def test_fetch_outcome(spark):
    schema = "status int, content_type string, error string, retry_after string"
    given = [
        ((404, "text/html", None, None), (False, "http_404", 30, None)),
        ((410, "text/html", None, None), (False, "http_410", 30, None)),
        ((200, "application/json", None, None), (True, "conteudo_nao_html", None, None)),
        ((200, "Text/HTML; charset=x", None, None), (True, None, None, None)),
        ((429, None, None, "7"), (False, "rate_limited", None, 7)),
        ((429, None, None, "soon"), (False, "rate_limited", None, 24)),
        ((503, None, None, None), (False, "http_503", None, 24)),
        ((403, None, None, None), (True, "http_403", None, None)),
        ((418, None, None, None), (False, "http_418", None, None)),
        ((None, None, "dns_falhou", None), (False, "dns_falhou", 30, None)),
        ((None, None, "ConnectTimeout", None), (False, "ConnectTimeout", None, 24)),
        ((None, None, "localhost", None), (False, "localhost", None, None)),
        ((302, None, "redirect_sem_location", None), (False, "redirect_sem_location", None, None)),
    ]
    for row, expected in given:
        got = pages.fetch_outcome(spark.createDataFrame([row], schema)).first()
        assert (got.reachable, got.fetch_error, got.retry_after_days, got.retry_after_hours) == expected


def test_rollup(spark):
    base = "https://www.loja.com.br"
    rows = [
        (base + "/", "<p>"), (base + "/produtos", "cdn.shopify.com /cart code.tawk.to"),
        (base + "/contato", "magento Mage.Cookies zendesk"), (base + "/p/", "/checkout"),
        (base + "/outra", "/finalizar compra coming soon"),
    ]
    frame = pages.page_signals(spark.createDataFrame(rows, "url string, html string"))
    row = pages.site_rollup(frame).first()
    assert (row.host, row.plataforma, row.plataforma_confianca) == ("loja.com.br", "shopify", 75)
    assert row.plataformas_detectadas == ["shopify", "magento"]
    assert row.chat_provider == "tawk" and row.has_cart and row.has_checkout
    assert row.coming_soon  # pages off the usual paths count too


def test_rollup_reads_every_page_of_a_large_site(spark):
    base = "https://www.loja.com.br"
    rows = [(f"{base}/artigo/{n}", "<p>") for n in range(18)]
    rows += [(base + "/home", "cdn.shopify.com"), (base + "/produtos/", "code.tawk.to /cart"), (base + "/zzz", "/checkout zendesk")]
    frame = pages.page_signals(spark.createDataFrame(rows, "url string, html string"))
    row = pages.site_rollup(frame).first()
    assert (row.plataforma, row.chat_provider) == ("shopify", "tawk") and row.has_cart and row.has_checkout
    order = spark.createDataFrame(
        [(u,) for u in (base, base + "/", base + "//", base + "/produtos/?x", base + "/p", base + "/home")], "url string")
    assert [r[0] for r in order.select(pages.visit_order(F.col("url"))).collect()] == [0, 0, 0, 1, 13, 14]
