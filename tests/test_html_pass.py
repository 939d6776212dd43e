"""E1-E5 on a contract document, tree recovery, and bounds on sloppy pages."""

from folio.operators.html_pass import extract, parse_html, to_markdown

# --- fixed values: contract vector (input fragments and, below, their expected output) ---
DOC = ("<html><head><title> T </title></head><body><div class=\"body markup\">"
       "<h2>A Subheading</h2><p>A paragraph with a <a href=\"https://clojure.org\">link</a> and "
       "<strong>bold text</strong>.</p><figure><div><img src=\"http://example.com/test.png\">"
       "<figcaption>A test image</figcaption></div></figure><blockquote><p>A quote.</p></blockquote>"
       "</div></body></html>")


def test_markdown_fragments():
    out = extract(DOC, frozenset({"body", "images", "links", "meta"}))
    md = out["body_md"]
    assert "\n## A Subheading\n" in md
    assert "paragraph with a [link](https://clojure.org)" in md
    assert "and **bold text**." in md
    assert "> A quote." in md
    assert '![A test image](example.com/test.png "")' in md
    assert out["body_kind"] == "div.body.markup"
    assert out["images"] == [{"pos": 0, "src": "http://example.com/test.png", "alt": "", "title": "",
                              "caption": "A test image", "local_path": "example.com/test.png"}]
    assert out["links"] == [{"pos": 0, "href": "https://clojure.org", "text": "link"}]
    assert out["title_text"] == " T "


def test_rules():
    md, imgs, errs = to_markdown(parse_html(
        "<ol><li>a</li><li>b</li></ol><hr><h4>h</h4><em>e</em><a>x</a><img src='z.png'>"
        "<figure><img src='/rel.png'></figure><script>var s='<p>';</script>").children)
    assert md == "\n* a\n* b\n\n---\nh*e*[x](null)var s='<p>';"
    assert imgs == [] and errs == 1


def test_tree_recovery_unclosed_p_and_b():
    root = parse_html("<body><p><b>one<br><p>two</p></body>")
    md, _, _ = to_markdown(root.children)
    assert md == "\n**one**\n\ntwo\n"


def test_short_page_body_text():
    html = "<html><head><script>var e='Too Many Requests'</script></head><body><pre>Too Many Requests</pre></body></html>"
    assert extract(html, frozenset({"short_body_text"}))["short_body_text"] == "Too Many Requests"


def test_clean_option_removes_furniture():
    html = ("<body><div class='body markup'><p>keep</p><div class='share-dialog'><p>share</p></div>"
            "<p class='button-wrapper x'>btn</p><div class='subscribe-widget'>sub</div>"
            "<div class='post-footer'>like</div></div></body>")
    assert extract(html, frozenset({"body", "clean"}))["body_md"] == "\nkeep\n"
    assert "share" in extract(html, frozenset({"body"}))["body_md"]


def test_unclosed_anchors_end_at_the_next():
    links = extract("<body><a href=1>x <a href=2>y <p><a href=3>z</body>", frozenset({"links"}))["links"]
    assert [(x["href"], x["text"]) for x in links] == [("1", "x"), ("2", "y"), ("3", "z")]


def test_sloppy_pages_cost_linear_time_and_output():
    import time
    html = "<body>" + "".join(f"<a href={i}>t{i} <span><div>" for i in range(20_000))
    start = time.process_time()
    links = extract(html, frozenset({"links"}))["links"]
    assert time.process_time() - start < 5
    assert len(links) == 20_000 and sum(len(x["text"]) for x in links) < 2 * len(html)


def test_first_container_with_children_is_the_body():
    empty = "<body><div class='body markup'></div><article><p>Text</p></article></body>"
    out = extract(empty, frozenset({"body"}))
    assert out["body_kind"] == "article" and "Text" in out["body_md"]


def test_short_body_text_without_a_body_tag():
    part = frozenset({"short_body_text"})
    assert extract("Too Many Requests", part)["short_body_text"] == "Too Many Requests"
    assert extract("<head><title>t</title></head><pre>Too Many Requests</pre>", part)["short_body_text"] == "Too Many Requests"
    assert extract("<body>" + "x" * 5000 + "</body>", part)["short_body_text"] is None


def test_large_pages_bound_the_worker_by_bytes():
    import pyarrow as pa

    from folio.operators.html_pass import _by_bytes
    batch = pa.RecordBatch.from_pydict({"html": ["a" * 5, None, "b" * 20, "c", "d"]})
    assert [b.num_rows for b in _by_bytes(batch, "html", 10)] == [2, 1, 2]
