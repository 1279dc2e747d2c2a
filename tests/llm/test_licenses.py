from pyspark.sql import functions as F

from tidemark.llm import licenses as L

MIT = L.LICENSES[0][1]


def test_variants_of_known_texts(spark):
    wrapped = "\n".join(" * " + line for line in MIT.replace(", ", ",\n").split("\n"))
    rows = [
        (1, MIT.upper().replace('"', "'")), (2, "Copyright (c) 2020 Jane Doe\nAll rights reserved.\n" + MIT.replace("sublicense", "sub-licence")),
        (3, wrapped), (4, "Some prose.\nLicenced under the  APACHE licence, version 2.0!\nMore prose."), (5, "Some prose only."),
        (6, "intro\n\nThis work is licensed under the\nGNU General Public License, version 3.\n\nend"), (7, None), (8, ""), (9, " \n "),
        (10, MIT + " And one more word."), (None, "Licensed under CC BY-NC 4.0."), (5, "Released under the MIT License."),
        (11, "x " * 500_000), (12, "MIT License\r\n\r\n© 2019 A. B.\r\n\r\n" + MIT), (13, "Licensed under CC BY 4.0.\nLicensed under CC BY 4.0."),
        (14, "Copyright notices are dull."),
    ]
    docs = spark.createDataFrame(rows, "doc_id int, text string").withColumn("license", F.lit("clash")).withColumn("digest", F.lit(1))
    found = {(r.id, r.license, r.unit) for r in L.scan(docs).collect()}
    assert found == {(1, "MIT", "text"), (2, "MIT", "text"), (3, "MIT", "text"), (4, "Apache-2.0", "line"), (5, "MIT", "text"),
                     (6, "GPL-3.0", "block"), (None, "CC-BY-NC-4.0", "text"), (12, "MIT", "text"), (13, "CC-BY-4.0", "line")}
    listed = L.by_document(docs).collect()
    assert len(listed) == len(rows) and all([tuple(x) for x in r.licenses] == sorted((n, u) for i, n, u in found if i == r.id) for r in listed)


def test_empty_table_and_plan_without_python(spark):
    docs = spark.createDataFrame([], "doc_id int, text string")
    assert L.by_document(docs).count() == 0
    plan = L.scan(spark.range(1).select("id", F.lit("a").alias("text")), "id")._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct"))
