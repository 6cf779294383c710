from flowtables.llm import langid as L
from llm_cases import documents, no_documents

SF = "/root/testdata/sf0.001"


def test_documents_and_pages(spark):
    rows = L.op2_langid(spark, SF).collect()
    want = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    docs = [r for r in rows if r.doc_id is not None]
    assert len(docs) == len(want) and sum(r.lang == want[r.doc_id] for r in docs) / len(docs) > 0.97
    pages = [r for r in rows if r.page_id is not None]
    assert len(pages) == spark.read.parquet(f"{SF}/pages.parquet").count()
    assert sum(r.lang == r.declared for r in pages) / len(pages) > 0.97


def _fused(spark, rows):
    df = spark.createDataFrame(rows, "id long, host string, domain string, suffix string, declared string, evidence array<double>, best int")
    return {r.id: r for r in L.fuse(df, ["de", "en"]).collect()}


def test_host_decides_when_the_text_does_not(spark):
    rows = [(i, "www.a.de", "a.de", "de", "de", [0.0, -9.0], 0) for i in range(30)]
    rows += [(100 + i, "www.b.com", "b.com", "com", "en", [-9.0, 0.0], 1) for i in range(30)]
    rows += [(200, "www.a.de", "a.de", "de", "", [0.0, 0.0], -1), (201, "www.b.com", "b.com", "com", "", [0.0, 0.0], -1)]
    rows += [(202, "new.b.com", "b.com", "com", "", [0.0, 0.0], -1), (203, "", "", "", "de", [0.0, 0.0], -1)]
    got = _fused(spark, rows)
    assert [got[i].lang for i in (200, 201, 202, 203)] == ["de", "en", "en", "de"]
    assert got[200].confidence > 0.9 and got[200].text_lang is None


def test_a_host_prior_against_brute_force(spark):
    import math

    rows = [(1, "h", "d", "s", "", [-0.1, 0.0], 1), (2, "h", "d", "s", "", [0.0, -0.3], 0), (3, "g", "d", "s", "", [0.0, -0.2], 0)]
    got = _fused(spark, rows)
    k = L.PRIOR_WEIGHT
    votes = [2, 1]
    for i, host_votes, all_host, best in ((1, [1, 1], 2, 1), (2, [1, 1], 2, 0), (3, [1, 0], 1, 0)):
        s = []
        for c in (0, 1):
            own = int(best == c)
            top = (votes[c] + 1) / 5
            domain = (votes[c] - own + k * top) / (3 - 1 + k)
            host = (host_votes[c] - own + k * domain) / (all_host - 1 + k)
            like = (votes[c] + 1) / (votes[c] + 1 + 1)
            s.append(rows[i - 1][5][c] + math.log(host) + 2 * math.log(like))
        assert got[i].lang == ["de", "en"][s.index(max(s))]
        assert abs(got[i].confidence - 1 / sum(math.exp(x - max(s)) for x in s)) < 1e-9


def test_visible_text_and_declarations(spark):
    page = '<HTML\n LANG = "De-AT"><style>p{}</style><script>var x="</p>";</script><nav>menu</nav><p>Gr&uuml;n<!-- no --></p>'
    assert L.visible_text(page).split() == ["Grün"] and L.visible_text(None) == ""
    df = spark.createDataFrame([(1, "HTTP://u@WWW.X.org:80/a?b", page), (2, None, None), (3, "no address", "<p>")], "page_id long, url string, html string")
    got = [(r.host, r.domain, r.suffix, r.declared) for r in L.page_records(df).orderBy("page_id").collect()]
    assert got == [("www.x.org", "x.org", "org", "de"), ("", "", "", ""), ("", "", "", "")]


def test_edge_rows(spark):
    docs = documents(spark)
    langs = L.languages_of(docs)
    rows = L.text_evidence(L.document_records(docs), L.train(docs, langs))
    assert L.fuse(rows, langs).count() == docs.count()
    none = no_documents(spark)
    assert L.languages_of(none) == [] and L.fuse(L.text_evidence(L.document_records(docs), L.train(none, [])), []).filter("lang IS NULL").count() == docs.count()
    assert L.fuse(L.text_evidence(L.document_records(none), L.train(docs, langs)), langs).count() == 0
