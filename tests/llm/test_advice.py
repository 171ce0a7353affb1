"""Cases in which the training-data operators did less than the whole job."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from outpour.llm import html, language, queries


def test_packed_ids_are_those_of_the_library_at_its_defaults(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n y", "<|endoftext| > no", "12½ '’s 😀", ""]
    found = queries.packed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = np.array([*library.encode(texts[row["doc_id"]], add_special_tokens=False).ids, 0], "<u4")
        assert (row["doc_tokens"], row["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))


def test_language_of_mostly_copies_is_learned_from_its_other_texts(spark):
    rng = random.Random(9)
    words = {"en": "the house of lord is there and with this", "de": "das haus ist nicht der wald und die zwei"}
    rows = [(" ".join(rng.choices(own.split(), k=30)), name) for name, own in words.items() for _ in range(60)]
    copies = spark.range(200_000).selectExpr("'das haus' AS text", "'de' AS lang")
    frame = spark.createDataFrame(rows, "text string, lang string").union(copies)
    model = language.fit(frame, "text", "lang", max_rows=400)
    assert model.languages == ("de", "en")
    assert all(model.predict(text)[0] == name for text, name in rows)


STORY = "<h1 class='post-header'>A title</h1><p>First paragraph of the story, with words.</p><p>Second one, with more of them.</p>"
STORY_TEXT = "A title\n\nFirst paragraph of the story, with words.\n\nSecond one, with more of them."


@pytest.mark.parametrize(
    "page",
    [
        f"<body class='single right-sidebar'><article>{STORY}</article></body>",
        f"<body class='sidebar'><main class='social'>{STORY}</main></body>",
        f"<body><div class='content no-comments'>{STORY}</div></body>",
        f"<body><article class='post has-header-image'>{STORY}</article></body>",
        f"<body><div class='widget'><article>{STORY}</article></div><div class='ad'>buy</div></body>",
        f"<body><form id='aspnet'><div>{STORY}</div><label>Name</label><button>go</button></form></body>",
        f"<body><form><article>{STORY}</article><div class='ad'>buy</div></form></body>",
        f"<body><article>{STORY}<p class='ad'>buy</p><form><p>sign up</p></form></article>"
        f"<section id='comments'><p>{'A reader says a lot here. ' * 40}</p></section></body>",
    ],
)
def test_names_and_forms_that_wrap_a_page_leave_its_text(page):
    assert html.main_text(page) == STORY_TEXT


def paragraphs(sizes):
    return [("word" + str(k) + " ") * (size // 6) for k, size in enumerate(sizes)]


@pytest.mark.parametrize(
    "sizes",
    [
        [300, 250, 180, 400, 320, 90, 280, 350],
        [*[200] * 10, 1500, *[200] * 10],
        [*[200] * 10, 4000, *[200] * 10],
        [30, 60, 500, 40, 20, 700, 90, 30],
    ],
)
@pytest.mark.parametrize("tag", ["p", "div"])
def test_pages_of_divs_keep_paragraphs_of_any_length(sizes, tag):
    texts = [text.strip() for text in paragraphs(sizes)]
    story = "".join(f"<{tag}>{text}</{tag}>" for text in texts)
    links = "<div>" + "".join(f"<div><a href=x>link number {k}</a></div>" for k in range(12)) + "</div>"
    whole = "\n\n".join(texts)
    assert html.main_text(f"<body>{story}</body>") == whole
    assert html.main_text(f"<body>{links}{story}{links}</body>") == whole
    boilerplate = "<div><div>Site name</div><div>Monday</div></div>"
    assert html.main_text(f"<body>{links}{boilerplate}<div class='text'>{story}</div>{boilerplate}{links}</body>") == whole
