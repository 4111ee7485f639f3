"""Clean texts that the pipeline's quality rules have to keep."""

import random

import duckdb

from daymatrix.llm import line_rules

HINDI = "भारत एक विशाल देश है जहाँ अनेक भाषाएँ बोली जाती हैं और हर राज्य की अपनी संस्कृति है। यहाँ के लोग त्योहारों को मिलकर मनाते हैं और अतिथियों का स्वागत करते हैं।"
FRENCH = (
    "« Bonjour », dit le boulanger en ouvrant la porte de sa boutique. « Avez-vous encore du pain frais ? » demanda "
    "la vieille dame. « Bien sûr, madame, il sort du four », répondit-il avec un grand sourire."
)
SWEDISH = FRENCH.replace("« ", "»").replace(" »", "»")


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice("river stone garden window letter morning summer travel story".split()) for _ in range(n))


def test_clean_texts_are_kept(documents):
    one = f"{prose(1, 60)} so read the privacy policy and click here {prose(2, 60)}"
    rows = [(1, HINDI), (2, FRENCH), (3, SWEDISH), (4, one)]
    assert sorted(r.doc_id for r in line_rules.kept_documents(documents(rows)).collect()) == [1, 2, 3, 4]


def test_lines_without_text_still_go(documents):
    lines = [
        "Home » News » Sport » Contact", "home | news | about us | terms", "• one • two • three", "%%% ### text &&&",
        "All rights reserved.", "This website uses cookies to improve your visit. By going on you accept our cookie policy and our terms of use.",
        "  Home ",
    ]
    text = "\n".join([prose(3, 40), *lines])
    assert [r.text for r in line_rules.cleaned(documents([(1, text)])).collect()] == [prose(3, 40)]


def test_query_and_sql_judge_lines_alike(documents, tmp_path):
    one = f"{prose(1, 60)} so read the privacy policy and click here {prose(2, 60)}"
    odd = ["Home » News » Sport » Contact", "a | b | c | d", "• x • y • z", "%%% ###", "Privacy policy", "‹ a › b › c › d", ""]
    rows = [(1, HINDI), (2, FRENCH), (3, SWEDISH), (4, one), (5, "\n".join([prose(3, 30), *odd])), (6, "\n".join(odd * 9)), (7, None)]
    docs = documents(rows)
    found = {r.doc_id: r for r in line_rules.apply_rules(docs).collect()}
    assert [i for i in sorted(found) if found[i].kept] == [1, 2, 3, 4, 5]
    docs.write.parquet(f"{tmp_path}/d")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    sql = db.execute(line_rules.ORACLE_SQL)
    names = [c[0] for c in sql.description]
    assert sorted(sql.fetchall()) == sorted(tuple(r[c] for c in names) for r in found.values())
