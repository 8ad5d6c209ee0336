from caretrail.llm.url_filter import RULES, host_and_path, judge, seed_urls, train, train_from, url_verdicts


def brute_rule(host, path):
    fits = []
    for verdict, rule in RULES:
        cut = rule.index("/")
        h, p = rule[:cut], rule[cut:]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def test_parts():
    assert host_and_path("HTTP://A.B.Com/x/Y?q#f") == ("a.b.com", "/x/Y")
    assert host_and_path("s://ÄB.net#top") == ("Äb.net", "")
    assert host_and_path("x?u=http://a.net/://b") == ("a.net", "/://b")
    assert host_and_path(None) == host_and_path("a.net/en/") == host_and_path("") == ("", "")


def test_rules_equal_brute_force(spark):
    urls = ["http://net/", "http://net", "http://a.net/x", "https://example.net/en/1", "https://w.example.net/en/", "http://Example.Net/en"]
    urls += ["http://notexample.net/en/", "http://anet/", "http://m.example.com/de/1", "http://example.com/fr/", "http://x.org/fr/1", None, "", "x"]
    rows = [(i if i else None, u, "c", "d") for i, u in enumerate(urls)] * 2
    df = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    out = url_verdicts(df).collect()
    assert len(out) == len(rows)
    for r, (i, u, *_) in zip(out, rows, strict=True):
        rule, verdict = brute_rule(r.host, r.path)
        assert (r.page_id, r.host, r.path, r.rule) == (i, *host_and_path(u), rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert url_verdicts(df.limit(0)).count() == 0


def test_model_tells_held_out_urls():
    urls = seed_urls()
    hosts = sorted({host_and_path(u)[0] for u, _ in urls})
    fold_of = {h: i % 20 for i, h in enumerate(hosts)}  # a host is held out with all its urls
    right = 0
    for fold in range(20):
        model = train([(u, y) for u, y in urls if fold_of[host_and_path(u)[0]] != fold])
        right += sum((model.score(*host_and_path(u)) >= 0.5) == bool(y) for u, y in urls if fold_of[host_and_path(u)[0]] == fold)
    assert right / len(urls) >= 0.7


def test_trained_from_a_table(spark):
    df = spark.createDataFrame([*seed_urls(), (None, 0), ("http://x.y/", None)], "url string, label int")
    model = train_from(df)
    assert model.score("cheap-pills.example.com", "/en/1") > 0.5 > model.score("www.school.example.com", "/en/1")
    assert judge(spark.createDataFrame([("http://m.free-bets.example.com/de2",)], "url string"), model).first().verdict == "block"


def test_kept_columns_with_names_of_results(spark):
    df = spark.createDataFrame([(1, "mine", "x", "http://a.net/en/1")], "page_id long, host string, __url string, url string")
    out = judge(df, train(seed_urls()), keep=("page_id", "host", "__url"))
    assert out.columns == ["page_id", "host_in", "__url", "host", "path", "rule", "verdict", "score"]
    assert (out.first().host_in, out.first().host, out.first().rule) == ("mine", "a.net", "net/")
