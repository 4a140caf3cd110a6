"""Generated pages with known main text, to train the block labeller.

Every page is drawn from a grammar of layouts: containers with the usual tags
and class names around the article, noise blocks outside and inside it, invented
words everywhere, so that structure and context tell the blocks apart and not
their words.
"""

from __future__ import annotations

import random

from reelstack.llm.html_blocks import Block

# Class names by kind of block; plain words that templates use.
NOISE = {
    "menu": (("nav", "div", "ul", "nav"), "nav menu navbar navigation breadcrumb breadcrumbs topnav links tabs "
             "pagination pager toc categories"),
    "header": (("header", "div", "header"), "header masthead top topbar banner logo branding head hero tagline"),
    "footer": (("footer", "div", "footer"), "footer copyright bottom legal colophon credits imprint contentinfo"),
    "sidebar": (("aside", "div", "section", "aside"), "sidebar side rail widget related popular trending recommended "
                "more stories tags archive recent posts latest suggested complementary"),
    "notice": (("div", "section", "dialog", "p", "aside"), "cookie cookies consent gdpr notice alert popup modal overlay "
               "message warning announcement paywall disclaimer privacy toast notification notices alertdialog"),
    "advert": (("div", "aside", "section", "ins", "div"), "ad ads advert advertisement sponsored promo promotion adslot "
               "adsense sponsor commercial affiliate advertising adverts"),
    "form": (("form", "div", "form"), "search login signup subscribe newsletter contact form register signin feedback "
             "subscription email"),
    "comments": (("section", "div", "ol", "section", "article"), "comments comment replies reply responses discussion "
                 "disqus thread readers reader commentlist respond"),
    "share": (("div", "ul", "section"), "share social follow sharing likes toolbar buttons print"),
}
MAIN = (("article", "main", "section", "div", "div", "article"), "article content post entry story main body text page "
        "prose rich single detail blog news")
CUES = {"menu": "home about contact news products services blog help", "header": "welcome site official daily",
        "footer": "© copyright rights reserved terms privacy policy imprint", "sidebar": "related popular read more latest",
        "notice": "cookies accept use this site agree privacy settings", "advert": "advertisement sponsored buy now offer",
        "form": "email password search submit subscribe name send", "comments": "reply says wrote posted ago thanks",
        "share": "share tweet facebook print email"}
SYLLABLES = ("the and of re in on er th es an ti or ing ed sha be lo mi ka ve ro du pel nir zu ost ach ein que eau los "
             "ión ü é ñ").split()


class Grammar:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choices(SYLLABLES, k=self.r.randint(1, 4)))

    def text(self, low: int, high: int, cues: str = "") -> str:
        words = [self.word() for _ in range(self.r.randint(low, high))]
        if cues and self.r.random() < 0.5:
            for w in self.r.sample(cues.split(), k=min(2, len(cues.split()))):
                words.insert(self.r.randint(0, len(words)), w)
        return " ".join(words) + self.r.choice(["", ".", ".", "!"])

    def element(self, kind: tuple, bare: float = 0.2) -> str:
        """Tag with the parts of its names, as ``names_of`` gives them."""
        tags, names = kind
        parts = [self.r.choice(tags)]
        if self.r.random() > bare or parts[0] in ("div", "section", "p", "ol", "ul"):
            parts += self.r.sample(names.split(), k=self.r.choice([1, 1, 1, 2]))
            if self.r.random() < 0.25:
                parts.insert(1, self.r.choice(["site", "js", "c", "page", "wrapper", "container", "block", "box", "module"]))
        return " ".join(parts)

    def noise(self, kind: str, above: tuple) -> list[Block]:
        path = (*above, self.element(NOISE[kind]))
        if kind == "comments" and path[-1] == "article":
            path = (*above, "article comment")
        if kind in ("notice", "advert", "sidebar") and self.r.random() < 0.15:
            path = (*above, self.r.choice(["div", "section"]), *path[len(above):])
        cues, out = CUES[kind], []
        if self.r.random() < 0.2:
            path = (*path, self.r.choice(["div", "div inner", "div container", "div row", "section"]))
        if kind in ("menu", "share") or (kind in ("sidebar", "footer") and self.r.random() < 0.5):
            if kind == "sidebar" and self.r.random() < 0.5:
                out.append(Block((*path, self.r.choice(["h2", "h3", "h4"])), self.text(1, 4, cues), 0.0))
            inner = self.r.choice([("ul", "li"), ("ul", "li"), ("li",), ("div",), ()])
            for _ in range(self.r.randint(1, 8)):
                out.append(Block((*path, *inner), self.text(1, 5, cues), self.r.choice([1.0, 1.0, 0.5])))
        elif kind == "form":
            for _ in range(self.r.randint(1, 4)):
                out.append(Block((*path, *self.r.choice([("label",), ("button",), ("p",), (), ("h3",), ("select", "option")])),
                                 self.text(1, 8, cues), 0.0))
        elif kind == "comments":
            if self.r.random() < 0.5:
                out.append(Block((*path, self.r.choice(["h2", "h3"])), self.text(1, 3, cues), 0.0))
            inner = self.r.choice([("div comment",), ("li",), ("li comment", "p"), ("article", "p"), ("p",), ("div", "p")])
            for _ in range(self.r.randint(1, 6)):
                out.append(Block((*path, *inner), self.text(3, 60, cues), self.r.choice([0.0, 0.0, 0.1])))
        else:
            inner = self.r.choice([(), (), ("p",), ("span",), ("div",), ("h2",)])
            for _ in range(self.r.randint(1, 3)):
                out.append(Block((*path, *inner), self.text(1, 40, cues), self.r.choice([0.0, 0.0, 0.3])))
        return out

    def main(self, above: tuple) -> tuple[list[Block], list[int]]:
        path = above
        for _ in range(self.r.choice([1, 1, 1, 2, 3])):
            path = (*path, self.element(MAIN, bare=0.45))
        if self.r.random() < 0.08:
            path = (*above, "div")
        out, label = [], []

        def put(block: Block, good: int = 1) -> None:
            out.append(block)
            label.append(good)

        if self.r.random() < 0.85:
            put(Block((*path, self.r.choice(["h1", "h1", "h1", "h2", "h1 title", "h1 headline"])), self.text(1, 14), 0.0))
        for _ in range(self.r.choice([1, 2, 3, 5, 8, 12, 18])):
            shape = self.r.random()
            if shape < 0.74:
                put(Block((*path, "p"), self.text(1, 120), self.r.choice([0.0, 0.0, 0.0, 0.1, 0.3])))
            elif shape < 0.82:
                put(Block((*path, self.r.choice(["h2", "h3", "h4"])), self.text(1, 8), 0.0))
            elif shape < 0.88:
                for _ in range(self.r.randint(2, 5)):
                    put(Block((*path, self.r.choice(["ul", "ol"]), "li"), self.text(1, 20), self.r.choice([0.0, 0.0, 0.4])))
            elif shape < 0.94:
                put(Block((*path, *self.r.choice([("blockquote",), ("blockquote", "p"), ("pre",), ("figure", "figcaption"),
                                                  ("table", "tr", "td"), ("div",), ("section", "p"), ()])), self.text(1, 60), 0.0))
            else:
                for block in self.noise(self.r.choice(["advert", "share", "notice", "sidebar", "form", "menu", "advert"]), path):
                    put(block, 0)
        if self.r.random() < 0.15:
            for block in self.noise("comments", path):
                put(block, 0)
        return out, label

    def page(self) -> tuple[list[Block], list[int]]:
        """Blocks of one page and 1 for each block of the article."""
        blocks, labels = [], []

        def noise(kinds: list, above: tuple, chance: float) -> None:
            for kind in kinds:
                if self.r.random() < chance:
                    found = self.noise(kind, above)
                    blocks.extend(found)
                    labels.extend([0] * len(found))

        if self.r.random() < 0.9:
            blocks.append(Block(("html", "head", "title"), self.text(1, 12), 0.0))
            labels.append(0)
        body = ("html", "body") if self.r.random() < 0.9 else ("html", "body", "div " + self.r.choice(
            ["wrapper", "container", "page", "site", "root", "app", "layout"]))
        early = ["menu", "header", "notice", "advert", "form", "share", "sidebar"]
        self.r.shuffle(early)
        noise(early, body, 0.35)
        found, label = self.main(body)
        blocks.extend(found)
        labels.extend(label)
        late = ["share", "advert", "comments", "sidebar", "form", "notice", "menu", "footer"]
        if self.r.random() < 0.5:
            self.r.shuffle(late)
        noise(late, body, 0.35)
        return blocks, labels


def pages(n: int, seed: int) -> list[tuple[list[Block], list[int]]]:
    grammar = Grammar(seed)
    return [grammar.page() for _ in range(n)]
