"""Tables of odd cases, written to a folder like the given tables."""

import pyarrow as pa
import pyarrow.parquet as pq

LONG = " ".join(f"word{i % 7000} of line{i % 13}\n" if i % 11 == 0 else f"word{i % 9000}" for i in range(60_000))
PASSAGE = ("the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree and "
           "count every star that falls behind the quiet hills of the northern valley before the morning comes again")
COPY = "\n".join(f"{PASSAGE} number {i}" for i in range(6))
WORDS = [w for w in (PASSAGE + " some more common words that make a text look like prose").split()]


def _prose(seed, n=120):
    return " ".join(WORDS[(seed * 7919 + i * (seed % 13 + 3) + i * i) % len(WORDS)] + ("." if i % 9 == 8 else "") for i in range(n))


TEXTS = [
    None, "", " \t\r\n\x0b\x0c ", "word", "two words", "\n\n\n", "a b c d", "A B C D E", "a b c d e", "É é ß ñ 漢字    x",
    "x" * 50_000, LONG, COPY, COPY.upper(), COPY.replace(" ", "  \t "), COPY + " tail", COPY.replace("seven", "eight", 1),
    "### *** $$$ %%% &&& ||| <<>>", "!!! ??? ---", "1 2 3 4 5 6 7 8 9 0", "\u0000 nul", "<|endoftext|> plain <|startoftext|>",
    "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "This is CC BY-NC 4.0 text",
    "under the-MIT/license and under the mit license", "This work is licensed under the GNU General Public License, version 3.",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "Permission is hereby granted, free of cost, to any person obtaining a copy of this software and associated documentation files",
    "mit license", "the license under the", "cc by", "CC\nBY\nNC", "KKİ under the mıt license",
    "a\nb\na\n b\nb\n\na", "same same same same same same", ("one two three four " * 40).strip(), "tail\r\ntail\r\n",
] + [_prose(i) for i in range(30)] + [f"{PASSAGE}\n{_prose(100 + i)}" for i in range(40)]


def documents():
    rows = []
    for i, text in enumerate(TEXTS):
        lang = [None, "en", "de", "fr", "es"][i % 5] if i < 38 else "en"
        source = [None, "src0", "src1", "other"][i % 4] if i < 38 else "src0"
        rows.append((1000 - 7 * i, text, lang, source))
    rows += [(5000 + i, COPY, "en", "src0") for i in range(40)]  # a hot group of copies
    rows += [(6000 + i, COPY.replace("owls", f"owls{i}", 1), "en", "src0") for i in range(30)]  # and of near copies
    rows += [rows[12], rows[12], rows[0]]  # repeated rows
    spelt = ["receive"] * 60 + ["recieve"] * 6 + ["recive"] * 7 + ["receeive"] * 5 + ["aardvark"] * 25 + ["ardvark"] * 5 + ["façade"] * 34
    spelt += ["facade"] * 5 + ["façades"] * 220 + ["fa×ade"] * 5 + ["z" * 70] * 5 + ["z" * 69] * 32 + ["z" * 64] * 5 + ["z" * 63] * 32 + ["z" * 5000] * 5
    rows += [(8000 + i, f"{w.upper() if i % 7 == 0 else w}, {w}-{w} {w}s?", "en", "other") for i, w in enumerate(spelt)]
    text = [r[1] for r in rows]
    return pa.table({
        "doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array(text, pa.string()),
        "lang": pa.array([r[2] for r in rows], pa.string()), "source": pa.array([r[3] for r in rows], pa.string()),
        "n_chars": pa.array([len(t or "") for t in text], pa.int64())})


def labels():
    ids = documents().column("doc_id").to_pylist()
    return pa.table({"doc_id": pa.array([*ids[:60], None, 10**9], pa.int64()),
                     "quality": pa.array([*[int(i >= 38) for i in range(60)], 1, 1], pa.int32()),
                     "toxic": pa.array([0] * 62, pa.int32())})


PAGE = "<html><body><nav>menu</nav><article><h1>T &amp; t</h1><p>{}</p></article><footer>&copy;</footer></body></html>"


def pages():
    same = PAGE.format("copy " * 300)
    htmls = [None, "", "plain", "<p>a<p>b", same, same, same.replace("copy", "cöpy"), "x" * 999, "x" * 999, "y" * 1000, "y" * 1000,
             "é" * 500, "é" * 500, "<", "<!-- open", "<div class='", "a &lt;b&gt; &amp", PAGE.format(" \n ".join(["long"] * 40_000))]
    urls = [None, "", "no url", "http://a.example/x\r\ny", "https://A.example:8080/?q", *["http://a.example/"] * (len(htmls) - 5)]
    ids = [*range(50, 50 - len(htmls), -1)]
    ids += [None, ids[9], ids[9]]
    htmls += [htmls[9], htmls[9], htmls[9]]
    urls += ["http://b.example", urls[9], urls[9]]
    return pa.table({"page_id": pa.array(ids, pa.int64()), "url": pa.array(urls, pa.string()), "html": pa.array(htmls, pa.string())})


def conversations():
    rows = [(c, t, ["user", "assistant"][t % 2], f"{'Ask' if t % 2 == 0 else 'Answer'} {t} of {c}.") for c in range(40) for t in range(c % 9)]
    rows += [(50, t, ["user", "assistant"][t % 2], f"Row {t % 200}." if t % 5 else f"row {t}") for t in range(3000)]  # a hot one, with repeats
    rows += [(60, 0, "system", "Be brief."), (60, 2, "user", " \t\n\x0b\x0c\r "), (60, 9, "user", "Cut off"), (60, 9, "user", "Also at 9?")]
    rows += [(61, None, "tool", "No turn!"), (61, None, None, None), (61, 3, "", "no role"), (61, 4, "Assistant", "É…")]
    rows += [(None, 1, "user", "Nobody's."), (None, None, "assistant", "Nobody's either.")]
    rows += [(62, -3, "user", "Long " * 30_000 + "."), (62, 0, "assistant", "a\nb\n!\n"), (63, None, None, None), (64, 5, "s", "?")]
    rows += [(65, t, "user", "ok.") for t in range(40)] + [(66, 1, "user", "Same."), (66, 1, "user", "Same."), (66, 1, "assistant", "Same.")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.table({n: pa.array(list(c), k) for n, c, k in zip(["conv_id", "turn", "role", "text"], zip(*rows, strict=True), kinds, strict=True)})


def embeddings():
    near = [[1.0, 0.5 + i / 1000, -0.25] for i in range(60)]
    rows = list(enumerate(near)) + [(100 + i, [0.1, -2.0, 3.0]) for i in range(90)]  # a hot group of copies
    rows += [(None, [2.0, 2.0, 2.0]), (None, [2.0, 2.0, 2.0]), (200, None), (220, [0.0, 0.0, -0.0]), (240, [1.0, None, 1.0]),
             (260, [float("nan"), 1.0, 1.0]), (280, [float("inf"), 1.0, 1.0]), (300, []), (320, [1.0]), (340, [1.0, 2.0, 3.0, 4.0]),
             (360, [5.0, 5.0, 5.0]), (360, [5.0, 5.0, 5.0]), (380, [5.0, 5.0, 5.0]), (380, [-5.0, 5.0, 5.0]), (-20, [-1.0, 0.0, 0.0])]
    return pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()),
                     "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())),
                     "label": pa.array([0] * len(rows), pa.int32())})


CLASHING = ["digest", "id", "key", "row", "token", "node", "size", "rate", "copy", "kept", "words", "low", "host", "doc", "weight",
            "quality", "n", "score", "pieces", "cdf", "payload", "group", "rows", "df", "new", "first", "_key", "lines", "path",
            "conv", "turns", "pos", "part", "head", "audit", "fault", "vec", "gid", "cell", "tree", "word", "form", "root"]


def _with_clashes(table):
    for name in CLASHING:
        table = table.append_column(name, pa.array(["x"] * len(table), pa.string()))
    return table


def write(folder, kind):
    """``odd`` cases, the same with ``clashing`` extra columns, or ``empty`` tables."""
    for name, table in (("documents", documents()), ("labels", labels()), ("pages", pages()),
                        ("conversations", conversations()), ("embeddings", embeddings())):
        table = _with_clashes(table) if kind == "clashing" and name != "labels" else table
        pq.write_table(table.slice(0, 0) if kind == "empty" else table, f"{folder}/{name}.parquet")
    return str(folder)
