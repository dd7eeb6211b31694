"""Pages without end tags."""

from selvatrace.llm import html_text


def test_unclosed_silent_elements():
    text = lambda s: [t for _, t in html_text.Page(s).blocks]
    assert text("<html><head><title>t</title><meta a><body><p>one<p>two") == ["one", "two"]
    assert text("<head><title>t</title><p>one") == ["one"] and text("<head><title>t</title>one <b>two</b>") == ["one two"]
    for name in ("select", "object", "canvas", "svg", "template"):
        assert text(f"<p>a</p><{name}>x<p>b</p><div>c</div>") == ["a", "b", "c"]
        assert text(f"<p>a</p><{name}>x</{name}><p>b</p>") == ["a", "b"]
    assert text("<object><p>x</p></object><svg><foreignObject><div>y</div></foreignObject></svg><p>b</p>") == ["b"]
