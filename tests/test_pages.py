from pyspark.sql import functions as F

from ouvidoria.sources import pages

LISTING = """<html><a class="resource-url-analytics" href="https://h/base2024-01.csv">x</a>
<a href='y' class="other" href="https://h/2024-01.pdf">n</a>
<a class="btn resource-url-analytics big" href="https://h/base2024-02.csv?a=1&amp;b=2">x</a>
<a class="resource-url-analytics" href="">empty</a><a class="resource-url-analytics-not" href="2024-01">no</a></html>"""


def test_links_by_class_and_text(spark):
    df = spark.createDataFrame([(1, LISTING), (2, "no links"), (3, None)], "id int, html string")
    every = [tuple(r) for r in pages.find_links(df, "html", css_class=pages.LISTING_CLASS).collect()]
    assert every == [(1, "https://h/base2024-01.csv"), (1, "https://h/base2024-02.csv?a=1&b=2")]
    some = pages.find_links(df, "html", containing="2024-01", css_class=pages.LISTING_CLASS).collect()
    assert [r.href for r in some] == ["https://h/base2024-01.csv"]


def test_records_stop_at_the_shortest_list(spark, rows):
    df = spark.createDataFrame([(1, "<h4>a</h4><p>1</p><h4>b</h4><p>2</p><h4>c</h4>"), (2, "<h4>a</h4>")], "id int, html string")
    got = rows(pages.extract_records(df, "html", {t: pages.element_texts(F.col("html"), t) for t in ("h4", "p")}))
    assert got == [(1, "a", "1"), (1, "b", "2")]


def card(n, comment="ok", reply_time="(respondido em 2 dias)"):
    return (
        f'<div class="card"><div class="relatos-nome-empresa x"><a href="#">Banco <b>{n}</b></a></div>'
        f"<div><h4>Resolvido</h4></div>"
        f"<div><span>0{n}/02/2024, Ji-Paraná - RO</span><p>Relato {n} | fim<br/>segunda linha</p></div>"
        f"<div><span>{reply_time}</span><p>Resposta {n}</p></div>"
        f"<div><p>Nota {n}</p><p>{comment}</p></div></div>"
    )


def test_portal_page_to_daily_fields(spark):
    page = f'<html><body><div id="resultados">{card(1)}{card(2, comment="")}</div></body></html>'
    got = pages.portal_records(spark.createDataFrame([(7, page)], "id int, page string"), "page").collect()
    assert [r.id for r in got] == [7, 7]
    first = got[0].asDict()
    assert first == {
        "id": 7, "nomeEmpresa": "Banco 1", "status": "Resolvido", "tempoResposta": "respondido em 2 dias",
        "dataOcorrido": "01/02/2024", "Cidade": "Ji-Paraná", "UF": "RO", "Relato": "Relato 1 ; fim segunda linha",
        "Resposta": "Resposta 1", "Nota": "Nota 1", "Comentario": "ok",
    }
    assert (got[1].Nota, got[1].Comentario) == ("Nota 2", "")


def test_no_page_is_dropped_and_no_record_mismatched(spark):
    linked = card(1).replace("Relato 1", "veja <a href=u>aqui</a> e <span>ali</span>")
    unclosed = card(3).replace("</p>", "").replace("Resposta 3", "n&atilde;o &eacute; <input disabled>")
    df = spark.createDataFrame(
        [(1, f"<html>{linked}{card(2)}</html>"), (2, f"<ul><li>{unclosed}<li>x"), (3, None), (4, card(4)[:-60])], "id int, page string"
    )
    got = {(r.id, r.nomeEmpresa): (r.Relato, r.Resposta) for r in pages.portal_records(df, "page").collect()}
    assert got[1, "Banco 1"] == ("veja aqui e ali ; fim segunda linha", "Resposta 1")
    assert got[1, "Banco 2"] == ("Relato 2 ; fim segunda linha", "Resposta 2")
    assert got[2, "Banco 3"] == ("Relato 3 ; fim segunda linha", "não é")
    assert all(i in (1, 2, 4) for i, _ in got)


def test_odd_pages_never_fail_a_job(spark):
    odd = [
        "no markup", "", "<p>a&nbsp;b & c</p>", "<html><body><br><img src='x'></body></html>",
        "<!DOCTYPE html><html><head><meta charset='utf-8'><script>if (a<b && c) {}</script></head><h4>a</h4></html>",
        "<h4>a</h4> trailing <b>", "<p>\x01control</p>", "<p>&ccedil;</p>", "<p a='1' a='2'>x</p>", "<div><p>x</div>",
        "<", "<a b>", "</p>", "<x:y>n</x:y>", "&#0;", "<p>]]></p>", "<![CDATA[x", "<!doctype", "<script>never closed",
    ]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(odd)], "id int, html string")
    assert pages.portal_records(df, "html").count() == 0


def test_links_in_any_quotes(spark):
    html = (
        "<a class='x resource-url-analytics' href='a.csv'>1</a><A HREF=b.csv CLASS=resource-url-analytics>2</a>"
        '<!-- <a class="resource-url-analytics" href="no">3</a> --><script>"<a class=resource-url-analytics href=no>"</script>'
        '<a data-href="no" title="a > b" href="c.csv" class="resource-url-analytics">4</a>'
    )
    found = pages.find_links(spark.createDataFrame([(1, html)], "id int, html string"), "html", css_class=pages.LISTING_CLASS)
    assert [r.href for r in found.collect()] == ["a.csv", "b.csv", "c.csv"]


def test_elements_keep_what_follows_inner_tags(spark):
    df = spark.createDataFrame([("<p><b>a</b> b<p class=x>c<br>d</p><pre>no</pre>",)], "x string")
    assert df.select(pages.element_texts(F.col("x"), "p")).first()[0] == ["a b", "cd"]


def test_element_text(spark):
    df = spark.createDataFrame([("<p>a &amp;lt; <b>b</b>\n c&gt;</p>",)], "x string")
    assert df.select(pages.element_text(F.col("x"))).first()[0] == "a &lt; b c>"
