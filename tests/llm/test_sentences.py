import pytest

from bartide.llm import sentences

HEAD = "commit 911d98103940d40661772840bce14ebdb6c397d4\nAuthor: A B <a@b.invalid>\nDate:   Sun Sep 25 02:17:36 2022 +0700\n\n"
CASES = {
    "english": ("Fix it. Drop rows.\n\nDr. A. B. Smith keeps 3.5 % at 10.0.38.1, e.g. fetch_rows. See no. 3 vs. the\nold one! It stops at 5 p.m. The end is slow... but right. scan_rows is next, etc. Prof. X agrees?!",
                ["Fix it.", "Drop rows.", "Dr. A. B. Smith keeps 3.5 % at 10.0.38.1, e.g. fetch_rows.", "See no. 3 vs. the\nold one!", "It stops at 5 p.m.", "The end is slow... but right.", "scan_rows is next, etc.", "Prof. X agrees?!"]),
    "quotes": ('a\n\nIt printed "No rows. Giving up." and returned 3. He said: "Bad header." The rest (it failed. Often.) stays. (The old path stays.) "Is it?" was asked.',
               ["a", 'It printed "No rows. Giving up." and returned 3.', 'He said: "Bad header."', "The rest (it failed. Often.) stays.", "(The old path stays.)", '"Is it?" was asked.']),
    "lists and trailers": ("Title without mark\n\n- first item\n- second. Item\n  goes on\n\n1. one\n2. two_three\n\nLast one, see\n16. The end.\n\nRefs: Q-1\nSigned-off-by: A <a@b>\n",
                           ["Title without mark", "first item", "second.", "Item\n  goes on", "one", "two_three", "Last one, see\n16.", "The end."]),
    "german": ("x\n\nSeit dem 3. März fehlt z. B. nichts. Im 9. Lauf bzw. später meldet er „Fehler. Ende.“ und hört auf. Siehe (s. S. 9). Gut.",
               ["x", "Seit dem 3. März fehlt z. B. nichts.", "Im 9. Lauf bzw. später meldet er „Fehler. Ende.“ und hört auf.", "Siehe (s. S. 9).", "Gut."]),
    "french and spanish": ("x\n\nPourquoi perd-il 28,8 % ? Il affiche « Erreur. Fin. » et s'arrête ! ¡Ya no se repite! Los EE. UU. el lunes, p. ej. hoy.",
                           ["x", "Pourquoi perd-il 28,8 % ?", "Il affiche « Erreur. Fin. » et s'arrête !", "¡Ya no se repite!", "Los EE. UU. el lunes, p. ej. hoy."]),
    "russian": ("x\n\nПроверено на 3 файлах и т. д. Готово, т. к. данных нет, см. рис. 9. Он печатает «Нет строк. Выход.» и стоп.", ["x", "Проверено на 3 файлах и т. д.", "Готово, т. к. данных нет, см. рис. 9.", "Он печатает «Нет строк. Выход.» и стоп."]),
    "chinese": ("x\n\n它打印“没有数据。退出。”然后返回。他说：“这样不行！”缺口已补齐……但还要检查。更小（见第9节。）文件a.py。see notes.读取器跳过v1.2。about 3 min. each.模块完成。",
                ["x", "它打印“没有数据。退出。”然后返回。", "他说：“这样不行！”", "缺口已补齐……但还要检查。", "更小（见第9节。）", "文件a.py。", "see notes.", "读取器跳过v1.2。", "about 3 min. each.", "模块完成。"]),
    "japanese": ("x\n\n「行がない。終了。」と表示して止まります。欠損を（図16参照。）直す？埋めた（第9回。）fetch_rowsが読む…。", ["x", "「行がない。終了。」と表示して止まります。", "欠損を（図16参照。）直す？", "埋めた（第9回。）", "fetch_rowsが読む…。"]),
    "thai": ("sdk: แก้ช่องว่าง\n\nรุ่น6.0.4ยังใช้ได้ โปรดดูไฟล์a/b.sql\nค่าลดลง The end.", ["sdk: แก้ช่องว่าง", "รุ่น6.0.4ยังใช้ได้", "โปรดดูไฟล์a/b.sql", "ค่าลดลง", "The end."]),
    "thai list": ("แก้x\n\n* ลบa_b\n* ลบc_d\n\n1. ลบe\n2. ลบf", ["แก้x", "ลบa_b", "ลบc_d", "ลบe", "ลบf"]),
    "hindi and arabic": ("x\n\nडॉ. Nilo ने जाँची। क्यों है? راجع د. Nida هذا الملف. لماذا ٪؟ تم!", ["x", "डॉ. Nilo ने जाँची।", "क्यों है?", "راجع د. Nida هذا الملف.", "لماذا ٪؟", "تم!"]),
    "diff": ("Only this\n\ndiff --git a/x b/x\n+ Not this. Nor this.", ["Only this"]),
    "headers": (HEAD + "    Title here\n\n    One 😀 two. Three\n    four.\n\ndiff --git a/x b/x\n", ["Title here", "One 😀 two.", "Three\n    four."]),
    "no message": (HEAD.rstrip("\n"), []),
    "line ends": (HEAD.replace("\n", "\r\n") + "Title\r\n\r\nOne. Two\r\nthree.　\r\n---\r\nNo.", ["Title", "One.", "Two\r\nthree."]),
    "empty": ("", []),
    "blank": (" \n\t　\n", []),
    "null": (None, []),
    "private use": ("A  b. C d.", ["A  b.", "C d."]),
    "only a diff": ("diff --git a/x b/x\n+ x. Y.", []),
}


@pytest.fixture(scope="module")
def split(spark):
    rows = [(i, t, 1) for i, (t, _) in enumerate(CASES.values())]
    df = spark.createDataFrame(rows, "doc_id int, text string, _m int")
    got = {}
    for r in sentences.split(df, "doc_id", "text").collect():
        got.setdefault(r.doc_id, []).append((r.start_char, r.end_char))
    return got


@pytest.mark.parametrize("name", CASES)
def test_case(split, name):
    i = list(CASES).index(name)
    text, want = CASES[name]
    assert [text[a:b] for a, b in sorted(split.get(i, []))] == want


def test_long_text(spark):
    n = 20_000
    df = spark.createDataFrame([(1, "Title\n\n" + "One two three. " * n), (1, "Title")], "doc_id int, text string")
    got = sorted(tuple(r)[1:] for r in sentences.split(df, "doc_id", "text").collect())
    assert len(got) == n + 2 and got[-1] == (7 + 15 * (n - 1), 7 + 15 * n - 1)
    assert sentences.split(df.limit(0), "doc_id", "text").count() == 0
