"""The small labelled table of the block classifier.

Each line is one labelled block sequence in a page: the template holds blocks
marked {+n} (article) or {-n} (not), n being the words of the block. The words
themselves do not matter; only counts, links and the surrounding elements do.
"""

from __future__ import annotations

import re

from isohyet.llm import block_tree

# Labelled pages. {+n}/{-n} is a block of n words; {-na} is n linked words.
PAGES = (
    '<nav><ul><li>{-1a}</li><li>{-1a}</li><li>{-2a}</li></ul></nav><div class="ad">{-8}</div><article><h1>{+6}</h1>'
    '<p>{+40}</p><p>{+3}</p><p>{+1}</p><p>{+70}</p></article><footer>{-9}</footer>',
    '<header><a href="/">{-2a}</a><p>{-6}</p></header><main><h1>{+9}</h1><p>{+25}</p><ul><li>{+6}</li><li>{+4}</li></ul>'
    '<p>{+2}</p></main><aside><h2>{-2}</h2><p>{-30}</p></aside><footer><p>{-20}</p></footer>',
    '<div id="cookie-notice"><p>{-24}</p></div><div class="sidebar"><h3>{-2}</h3><ul><li>{-4a}</li><li>{-5a}</li></ul>'
    '<p>{-45}</p></div><article><header><h1>{+5}</h1></header><p>{+1}</p><p>{+33}</p><h2>{+3}</h2><p>{+60}</p>'
    '</article><section id="comments"><h2>{-2}</h2><div class="comment"><p>{-35}</p></div><div class="comment">'
    '<p>{-3}</p></div></section><footer>{-12}</footer>',
    '<article><h1>{+7}</h1><p>{+50}</p><div class="advert"><p>{-10}</p></div><p>{+45}</p><div class="share">{-3a}</div>'
    '<p>{+5}</p><form><label>{-3}</label></form><p>{+28}</p><div class="comments"><p>{-55}</p><p>{-2}</p></div></article>',
    '<article><h1>{+4}</h1><p>{+1}</p><p>{+2}</p><p>{+1}</p></article><div class="ad">{-1}</div><footer>{-5}</footer>',
    '<body><div class="menu">{-1a}</div><div class="menu">{-2a}</div><h1>{+8}</h1><p>{+45}</p><p>{+32}</p><p>{+60}</p>'
    '<div class="footer">{-11}</div></body>',
    '<body><table><tr><td>{-2a}</td><td>{-1a}</td><td>{-2a}</td></tr></table><h1>{+7}</h1><p>{+55}</p><p>{+20}</p>'
    '<p>{+38}</p><ul><li>{-3a}</li><li>{-4a}</li><li>{-3a}</li></ul></body>',
    '<div><p>{+44}</p><p>{+31}</p><p>{+18}</p><p>{+52}</p></div><ul><li>{-2a}</li><li>{-2a}</li></ul><p class="copyright">{-7}</p>',
    '<div class="newsletter"><h3>{-5}</h3><p>{-26}</p></div><main><p>{+22}</p><p>{+14}</p><blockquote>{+19}</blockquote>'
    '<p>{+3}</p></main><div class="related"><h3>{-2}</h3><p>{-8a}</p><p>{-9a}</p></div>',
    '<div role="navigation">{-4a}</div><div role="main"><h1>{+6}</h1><p>{+21}</p><p>{+1}</p></div><div role="contentinfo">{-16}</div>',
    '<article><h1>{+10}</h1><p>{+15}</p><p>{+6a}</p><p>{+48}</p></article><aside><p>{-48}</p><p>{-15}</p></aside>',
    '<form><p>{-12}</p><p>{-31}</p></form><article><p>{+12}</p><p>{+31}</p><table><tr><td>{+1}</td><td>{+2}</td></tr></table>'
    '</article><div class="popup"><p>{-31}</p></div>',
    '<nav>{-1a}</nav><article><h1>{+5}</h1><p>{+1}</p><p>{+2}</p></article><footer>{-4}</footer>',
    '<ul><li>{-2a}</li><li>{-1a}</li></ul><article><p>{+2}</p><p>{+3}</p><p>{+1}</p><p>{+7a}</p><p>{+2}</p></article>',
    '<div class="nav">{-3a}</div><main><h1>{+3}</h1><p>{+1}</p><p>{+4a}</p><p>{+1a}</p><p>{+1}</p></main><p>{-6}</p>',
    '<div class="layout has-sidebar"><form class="page-header"><article><h1>{+6}</h1><p>{+30}</p><p>{+2}</p></article></form>'
    '<div class="sidebar"><p>{-30}</p></div></div>',
    '<div class="with-comments no-ads"><div class="menu-wrapper">{-2a}</div><main><datalist><option>no<option>no</datalist>'
    '<p>{+35}</p><svg class="icon"/><p>{+8}</p></main><section class="comments"><article class="comment-body"><p>{-35}</p>'
    '</article></section></div>',
    '<p>{-9}</p><article><p>{+1a}</p><p>{+3}</p><p>{+90}</p></article><p>{-14}</p>',
)


def labelled_blocks() -> list[tuple[tuple[float, ...], int]]:
    """(features, label) of every block of the labelled pages."""
    out = []
    for page in PAGES:
        labels = [1 if sign == "+" else 0 for sign in re.findall(r"\{([+-])", page)]
        text = re.sub(r"\{[+-](\d+)(a?)\}", lambda m: (
            f'<a href="/x">{" ".join(["word"] * int(m[1]))}</a>' if m[2] else " ".join(["word"] * int(m[1]))), page)
        blocks = block_tree.blocks_of(text)
        if len(blocks) != len(labels):
            raise ValueError(f"{len(blocks)} blocks for {len(labels)} labels in {page[:60]}")
        out += list(zip(block_tree.features_of(blocks), labels))
    return out
