"""Main texts that rules must not take, and frames that templates alone take."""

import random

import pytest

from claimgraph.llm import html_text

STORY = "<article><h1>Title</h1><p>story one</p><p>story two</p></article>"
TEXT = "Title\n\nstory one\n\nstory two"
PAGES = "page_id long, url string, html string, part int, parts int"


@pytest.mark.parametrize(
    ("html", "want"),
    [
        (f'<body><form id="aspnetForm"><nav><a href="/">Home</a></nav>{STORY}<select><option>de</select></form></body>', TEXT),
        ('<body><form id="aspnetForm"><div><h1>Title</h1><p>story one</p></div><button>Send</button></form><footer>imprint</footer></body>', "Title\n\nstory one"),
        (f'<div role="dialog search">{STORY}</div>', TEXT),
        ('<div role="main-form form"><p>all of the text that there is</p></div><div role="search">Find <a href="/">it</a></div>', "all of the text that there is"),
        (f"{STORY}<form><p>{'Write to us about anything you like. ' * 20}</p></form>", TEXT),
        (f'{STORY}<div role="dialog"><p>{"We use cookies. " * 30}</p></div>', TEXT),
        ('<article><p>one</p><section class="related-work"><p>of others</p></section><div id="share-price"><p>12 Euro</p></div><div class="social-sciences">x</div></article>', "one\n\nof others\n\n12 Euro\n\nx"),
        ('<article><p>one</p><section class="related-posts"><p>more</p></section><div id="share"><p>tell</p></div><div class="share-buttons"><p>all</p></div><div class="x ads">buy</div></article>', "one"),
        ('<div class="related-work"><p>menu</p></div><div><p>body text in plain blocks</p></div>', "body text in plain blocks"),
        (f'<div class="text">{"<p>A long text in plain blocks.</p>" * 9}</div><article>teaser</article>', "\n\n".join(["A long text in plain blocks."] * 9 + ["teaser"])),
        (f"<div>beside</div>{STORY}", TEXT),
        ("<article></article><p>body</p>", "body"),
        ('<a href="/">only</a><ul><li><a href="/b">links</a></ul>', "only\n\nlinks"),
        ("", ""),
    ],
)
def test_rules_leave_the_main_text(html, want):
    assert html_text.main_text(html, set())[0] == want


def site(k, menu, body=None):
    """A page with its own number of menu links, none of which another page has, and no name that a rule knows."""
    links = "".join(f'<li><a href="/{k}/{i}">Topic {chr(97 + k % 26)}{i} of {k}</a></li>' for i in range(menu))
    return f"<body><div id=top><ul>{links}</ul></div>{body or f'<div><h2>Story {k}</h2><p>text number {k} of <a href=/x>many</a></p></div>'}<div>Page {k} of 99</div></body>"


def test_menus_of_other_links_recur(frame):
    """Only templates can take these: switching them off leaves menus in the texts."""
    rows = [(k, "http://site/", site(k, 2 + k % 5), 1, 1) for k in range(30)] + [(100 + k, f"http://small{k}/", site(k, 4), 1, 1) for k in range(3)]
    got = {r["page_id"]: r for r in html_text.extract_text(frame(rows, PAGES)).collect()}
    for k in range(30):
        assert got[k]["text"] == f"Story {k}\n\ntext number {k} of many\n\nPage {k} of 99" and got[k]["template_chars"] > 0 and got[k]["rule_chars"] == 0
    assert "Topic" in got[101]["text"]


def test_pages_of_links_and_lists_in_articles_stay(frame):
    rows = [(k, "http://site/", site(k, 3, "<ul><li><a href=/a>A</a><li><a href=/b>B</a></ul>").replace("<div>Page", f"<div><a href=/{k}>next</a></div><!--").replace("of 99</div>", "-->"), 1, 1) for k in range(12)]
    rows += [(100 + k, "http://other/", f"<article><p>text {k}</p><ul><li><a href=/{k}>Source {k}</a></li></ul></article>", 1, 1) for k in range(12)]
    got = {r["page_id"]: r["text"] for r in html_text.extract_text(frame(rows, PAGES)).collect()}
    assert all("A\n\nB" in got[k] and f"Source {k}" in got[100 + k] for k in range(12))


def generated(rng, k, host):
    """A page of random frame around an article of known blocks."""
    words = lambda n: " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rng.randrange(1000)) for _ in range(n))
    blocks = [words(rng.randint(1, 30)) for _ in range(rng.randint(1, 8))]
    inner = "".join(rng.choice(["<p>{}</p>", "<h2>{}</h2>", "<ul><li>{}</li></ul>", "<blockquote>{}</blockquote>", "<div class=related-work>{}</div>", "<table><tr><td>{}</table>"]).format(b) for b in blocks)
    story = rng.choice(["<article>{}</article>", "<main><div>{}</div></main>", "<div class=post><article class='tag-ads'>{}</article></div>", "<form id=f><article>{}</article></form>", "<div role=dialog><article>{}</article></div>"]).format(inner)
    before = [f"<nav><ul>{''.join(f'<li><a href=/{i}>{words(1)}</a>' for i in range(rng.randint(1, 5)))}</ul></nav>", f"<div class='ad big'>{words(5)}</div>", "<header><p>Name of site</p></header>", f"<aside>{words(4)}</aside>", "<script>var x = '<p>no</p>';</script>"]
    after = [f"<footer>{words(3)}</footer>", f"<div id=comments><article class=comment>{words(6)}</article></div>", f"<form><p>{words(3)}</p><input><button>Go</button></form>", f"<section class='newsletter signup'>{words(4)}</section>"]
    pick = lambda parts: "".join(p for p in parts if rng.random() < 0.6)
    return (k, f"http://{host}/{k}", f"<html><head><title>{words(2)}</title></head><body>{pick(before)}{story}{pick(after)}</body></html>", 1, 1), "\n\n".join(blocks)


def test_generated_pages(frame):
    rng = random.Random(4)
    made = [generated(rng, k, f"h{k % 4}.org") for k in range(200)]
    got = {r["page_id"]: r["text"] for r in html_text.extract_text(frame([r for r, _ in made], PAGES)).collect()}
    assert got == {r[0]: text for r, text in made}


def test_a_large_host_is_dealt_over_parts(frame):
    rows = [(k, "http://big/", site(k, 3), 1, 1) for k in range(400)] + [(1000 + k, None, site(k, 3), 1, 1) for k in range(20)]
    got = {r["page_id"]: r for r in html_text.extract_text(frame(rows, PAGES)).collect()}
    assert len(got) == 420 and all("Topic" not in r["text"] for r in got.values())
