"""The command line runs the layer jobs in order on one lake."""

import json

from reelstack.sources import read_star
from reelstack.__main__ import main, parse, run
from reelstack.layout import Layout
from reelstack.params import SUBSET_IDS
from reelstack.schemas import MOVIES_CSV, PAGES_RAW
from reelstack.session import scratch_path

DAY = "2024-04-12"


def test_cli_runs_every_layer(spark, tmp_path, capsys):
    root = scratch_path(spark, "lake")
    layout = Layout(root)
    result = (1, "Movie", "2005-01-01", 2.0, 7.0, 100, False)
    spark.createDataFrame([(2005, 14, 1, 200, 1, [result])], PAGES_RAW) \
        .write.json(layout.raw_pages(DAY))
    details = scratch_path(spark, "details")
    spark.createDataFrame([(1, 500, SUBSET_IDS[0], 120, 900)],
                          "id long, budget long, imdb_id string, runtime int, revenue long") \
        .write.json(details)
    extract = tmp_path / "movies.csv"
    row = dict.fromkeys(MOVIES_CSV.names, "")
    row.update(id=SUBSET_IDS[0], tituloPincipal="HP", anoLancamento="2005", tempoMinutos="120",
               genero="Fantasy", notaMedia="7", numeroVotos="99", personagem="Harry Potter")
    extract.write_text("|".join(MOVIES_CSV.names) + "\n" + "|".join(row.values()) + "\n")

    base = ["--root", root, "--day", DAY]
    run(spark, parse(["land", *base, "--movies", str(extract)]))
    run(spark, parse(["raw-ingest", *base, "--details", details]))
    run(spark, parse(["trusted-api", *base]))
    run(spark, parse(["trusted-catalog", *base]))
    for star in ("geral", "sagas"):
        run(spark, parse(["star", *base, "--star", star]))
    assert main(["report", *base, "--star", "sagas"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert {k: v["rows"] for k, v in out["result"].items()} == {
        "tabela_fato_sagas": 1, "tabela_sagas_data": 1, "tabela_sagas_titulo": 1, "tabela_sagas_adulto": 1}
    titles = out["result"]["tabela_sagas_titulo"]["columns"]
    assert titles["Titulo"]["mn"] == "HP" and out["result"]["tabela_fato_sagas"]["columns"]["orcamento"]["mx"] == "500"
    fact = read_star(spark, layout.refined("geral"))["tabela_fato"].first()
    assert (fact.fato_imdb_id, fact.orcamento, fact.data_coleta_tmdb) == (SUBSET_IDS[0], 500,
                                                                         "2024/04/12")
