import datetime as dt
import os
import shutil
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from surtido.operators import constraints as k
from surtido.operators.cleaning import clean_lines
from surtido.operators.series import KEY
from surtido.plans import reload as job
from surtido.plans.training import train
from surtido.schemas import PREDICCIONES, PRODUCTOS, VENTAS, to_stored
from surtido.session import ensure_checkpoint_dir
from surtido.sinks import (
    append_forecasts, append_sales, clear_tables, dense_key, insert_ignore, write_clean, write_jdbc,
)
from surtido import session, versions
from surtido.sources import read_audit, read_clean, read_metrics, read_model, read_stored
from surtido.streaming.landing import arrivals, watch_landing
from surtido.versions import current

DAY = dt.date(2011, 1, 1)


def products(spark, *codes, name="N"):
    return spark.createDataFrame([(c, name, None, Decimal("1.00")) for c in codes], PRODUCTOS)


def test_constraints_report_every_broken_rule(spark):
    loose = "id_producto string, nombre string, categoria string, precio_unitario double"
    productos = spark.createDataFrame(
        [("a", "N", "c", 1.0), ("a", None, "c", None), (None, "x" * 256, "c", 1e9),
         ("l" * 21, "N", None, 1.0)], loose)
    ventas = spark.createDataFrame(
        [(1, "1", "a", DAY, 1, 1.0), (1, "2" * 21, "zz", None, 0, None), (2, None, None, DAY, -3, 1e8)],
        "id_venta bigint, id_venta_original string, id_producto string, fecha_venta date, "
        "unidades_vendidas int, total_venta double")
    predicciones = spark.createDataFrame(
        [(1, "zz", DAY, 1, 1, 10.5), (2, None, None, None, None, None)],
        "id_prediccion bigint, id_producto string, fecha_prediccion date, unidades_predichas int, "
        "unidades_vendidas int, confianza_modelo double")
    got = {(r.tabla, r.restriccion): r.filas
           for r in k.validate_constraints(productos, ventas, predicciones).collect()}
    broken = {key: n for key, n in got.items() if n}
    assert broken == {
        ("productos", "id_producto not null"): 1, ("productos", "nombre not null"): 1,
        ("productos", "precio_unitario not null"): 1,
        ("productos", "precio_unitario decimal(10,2)"): 1,
        ("productos", "id_producto varchar(20)"): 1, ("productos", "nombre varchar(255)"): 1,
        ("productos", "id_producto primary key"): 1,
        ("ventas", "fecha_venta not null"): 1, ("ventas", "unidades_vendidas > 0"): 2,
        ("ventas", "total_venta not null"): 1, ("ventas", "total_venta decimal(10,2)"): 1,
        ("ventas", "id_venta_original varchar(20)"): 1,
        ("ventas", "id_producto references productos"): 1, ("ventas", "id_venta primary key"): 1,
        ("predicciones", "fecha_prediccion not null"): 1,
        ("predicciones", "confianza_modelo decimal(5,4)"): 1,
        ("predicciones", "id_producto references productos"): 1,
    }
    assert k.broken_rows(ventas, "ventas").count() == 2
    good, bad = k.split_orphans(ventas, productos)
    assert (good.count(), [r.id_producto for r in bad.collect()]) == (2, ["zz"])


def test_category_has_a_default(spark):
    row = to_stored(products(spark, "a").drop("categoria"), "productos").first()
    assert row.categoria == "Sin categoría"


def test_stored_types_are_strict(spark):
    df = spark.createDataFrame([("a", "N", "c", 1e9)],
                               "id_producto string, nombre string, categoria string, precio_unitario double")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        to_stored(df, "productos").collect()


@pytest.mark.parametrize("order", [(), ("v",)])
def test_dense_keys_have_no_gaps(spark, order):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(7)
    rows = rows.filter("v % 3 <> 0").unionByName(rows.filter("v = 5"))
    keyed = dense_key(rows, "clave", order)
    n = rows.count()
    assert sorted(r.clave for r in keyed.collect()) == list(range(1, n + 1))
    if order:
        assert [r.v for r in keyed.orderBy("clave").collect()] == sorted(
            r.v for r in rows.collect())


def test_checkpoint_folder_is_shared_and_stable(spark):
    assert ensure_checkpoint_dir(spark) == ensure_checkpoint_dir(spark)


def test_insert_ignores_stored_and_repeated_keys(spark, tmp_path):
    folder = str(tmp_path)
    clear_tables(spark, folder)
    insert_ignore(products(spark, "a", "b", name="first"), folder)
    insert_ignore(products(spark, "b", "c", "c", name="second"), folder)
    insert_ignore(products(spark, "b", "c", name="third"), folder)
    stored = {r.id_producto: r.nombre for r in read_stored(spark, folder, "productos").collect()}
    assert stored == {"a": "first", "b": "first", "c": "second"}


def test_appends_number_their_rows_and_accept_none(spark, clean_sales, tmp_path):
    folder = str(tmp_path)
    clear_tables(spark, folder)
    append_sales(clean_sales(("a", "2011-01-01", 2), ("a", "2011-01-01", 2)), folder)
    ventas = read_stored(spark, folder, "ventas")
    assert [f.dataType for f in ventas.schema] == [f.dataType for f in VENTAS]
    keys = [r.id_venta for r in ventas.collect()]
    assert len(set(keys)) == 2 and min(keys) > 0
    rows = spark.createDataFrame(
        [("a", DAY, 2.5, 3.5, None), ("a", DAY, 1.0, 1.0, 0.87654)],
        "id_producto string, fecha_prediccion date, unidades_predichas double, "
        "unidades_vendidas double, confianza_modelo double")
    append_forecasts(rows.limit(0), folder)
    assert read_stored(spark, folder, "predicciones").count() == 0
    append_forecasts(rows, folder)
    stored = read_stored(spark, folder, "predicciones")
    assert [f.dataType for f in stored.schema] == [f.dataType for f in PREDICCIONES]
    got = {(r.unidades_predichas, r.unidades_vendidas, r.confianza_modelo) for r in stored.collect()}
    assert got == {(2, 4, None), (1, 1, Decimal("0.8765"))}
    clear_tables(spark, folder)
    assert read_stored(spark, folder, "ventas").count() == 0


def test_clean_set_as_csv(spark, raw_lines, tmp_path):
    path = write_clean(clean_lines(raw_lines({}, {"StockCode": 'q"'})), str(tmp_path), "csv")
    rows = spark.read.option("header", True).option("escape", '"').csv(path).collect()
    assert sorted(r.id_producto for r in rows) == ["A", 'Q"']


def test_jdbc_writer_is_only_prepared(spark):
    assert write_jdbc(spark.range(1), "jdbc:x", "t") is not None


LINES = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


def invoice_file(path, units, months=24):
    """Two products sold on the first 26 days of every month, one returned line a month."""
    with open(path, "w", encoding="utf-8") as file:
        file.write(LINES)
        for i in range(months):
            year, month = 2010 + i // 12, i % 12 + 1
            for day in range(1, 27):
                file.write(f"{i}{day:02d},a, thing ,{units + i % 5},{month}/{day}/{year} 8:00,1.25,7,UK\n")
                file.write(f"{i}{day:02d},b,other,{units},{month}/{day}/{year} 9:00,2.5,,UK\n")
            file.write(f"C{i},a,thing,-1,{month}/1/{year} 8:00,1.25,7,UK\n")


def units(spark, folder):
    return read_stored(spark, folder, "ventas").agg(F.sum("unidades_vendidas")).first()[0]


def test_reload_end_to_end(spark, tmp_path):
    source, folder = str(tmp_path / "lines.csv"), str(tmp_path / "out")
    invoice_file(source, 10)
    job.reload(spark, source, folder)
    clean = read_clean(spark, folder)
    assert clean.count() == 2 * 26 * 24 == read_stored(spark, folder, "ventas").count()
    assert read_stored(spark, folder, "productos").count() == 2
    forecasts = read_stored(spark, folder, "predicciones")
    assert forecasts.count() == 3 * 12
    assert {r.y for r in forecasts.select(F.year("fecha_prediccion").alias("y")).distinct().collect()} == {2012}
    assert sorted(r.id_prediccion for r in forecasts.collect()) == list(range(1, 37))
    assert forecasts.filter("id_producto is null").count() == 12
    r2 = read_metrics(spark, folder).first().r2
    assert float(forecasts.first().confianza_modelo) == pytest.approx(min(1, max(0, r2)), abs=1e-4)
    assert read_model(spark, folder).count() == 1
    audit = read_audit(spark, folder).orderBy("orden").collect()
    assert [(r.paso, r.filas) for r in audit][:5] == [
        ("inicio", 53 * 24), ("sin_cancelaciones", 52 * 24), ("cantidad_positiva", 52 * 24),
        ("precio_positivo", 52 * 24), ("sin_duplicados", 52 * 24)]
    assert [r.filas for r in audit][5:] == [0, 2, 52 * 24, 52 * 24]
    months = spark.read.option("header", True).csv(f"{current(spark, folder)}/predicciones_ridge")
    assert months.count() == 12 and "ventas_reales" in months.columns
    violations = k.validate_constraints(
        read_stored(spark, folder, "productos"), read_stored(spark, folder, "ventas"), forecasts)
    assert violations.filter("filas > 0").count() == 0
    again = str(tmp_path / "again")
    job.reload(spark, source, again, placeholder_confidence=True)
    assert read_stored(spark, again, "predicciones").first().confianza_modelo == Decimal("1.0000")


def test_a_failed_reload_leaves_the_stored_tables(spark, tmp_path, monkeypatch):
    source, folder = str(tmp_path / "lines.csv"), str(tmp_path / "out")
    invoice_file(source, 10)
    job.reload(spark, source, folder)
    before = units(spark, folder)
    invoice_file(source, 30, months=2)

    def fail(*args, **kwargs):
        raise RuntimeError("training failed")

    monkeypatch.setattr(job, "Training", fail)
    with pytest.raises(RuntimeError):
        job.reload(spark, source, folder)
    assert units(spark, folder) == before
    assert read_clean(spark, folder).count() == 2 * 26 * 24
    assert len(os.listdir(f"{folder}/_versiones")) == 1


def test_a_reload_is_published_at_once(spark, tmp_path, monkeypatch):
    """Whatever file operation fails, readers find all the old tables or all the new ones."""
    folder = str(tmp_path / "out")
    sources = [str(tmp_path / f"lines_{k}.csv") for k in range(2)]
    for source, amount in zip(sources, (10, 30)):
        invoice_file(source, amount, months=16)

    def found():
        return (units(spark, folder), read_clean(spark, folder).agg(F.sum(
            "unidades_vendidas")).first()[0], read_audit(spark, folder).count(),
            read_stored(spark, folder, "predicciones").agg(F.sum("unidades_predichas")).first()[0])

    for source in sources:
        job.reload(spark, source, folder)
    new = found()
    job.reload(spark, sources[0], folder)
    old = found()
    assert old[0] != new[0] and old[3] != new[3]

    # Only the publication is tried again and again; the tables are written once a trial.
    made = current(spark, folder)
    monkeypatch.setattr(job, "load_dataset", lambda *a, **o: None)
    monkeypatch.setattr(job, "store_clean", lambda raw, version: version)
    monkeypatch.setattr(job, "store_tables", lambda clean, version, days: shutil.copytree(
        prepared, version))
    monkeypatch.setattr(job, "store_audit", lambda *a: None)
    monkeypatch.setattr(job, "store_forecasts", lambda *a, **o: None)
    prepared = str(tmp_path / "prepared")
    older = sorted(os.listdir(f"{folder}/_versiones"))
    shutil.copytree(next(f"{folder}/_versiones/{n}" for n in older if not made.endswith(n)),
                    prepared)
    calls = [0]

    def failing(name, module, at):
        whole = getattr(module, name)

        def tried(*args):
            calls[0] += 1
            if calls[0] == at:
                raise RuntimeError("lost")
            result = whole(*args)
            calls[0] += 1
            if calls[0] == at:  # done, but the caller does not learn of it
                raise RuntimeError("lost after it was done")
            return result

        monkeypatch.setattr(module, name, tried)

    outcomes = []
    for at in range(1, 40):
        with monkeypatch.context() as patch:
            monkeypatch, outer = patch, monkeypatch
            calls[0] = 0
            for module, name in ((session, "rename_new"), (versions, "put_new_text"),
                                 (versions, "remove_folder"), (versions, "read_text")):
                failing(name, module, at)
            try:
                job.reload(spark, "", folder)
                done = True
            except RuntimeError:
                done = False
            monkeypatch = outer
        outcomes.append(found())
        assert outcomes[-1] in (old, new)
        if done:
            break
    assert done and outcomes[-1] == new and len(set(outcomes)) >= 1
    assert any(o == old for o in outcomes)
    assert len(os.listdir(f"{folder}/_publicadas")) <= 2 + 2 * len(outcomes)


def test_a_reload_keeps_two_versions_and_reads_its_input_once(spark, raw_lines, tmp_path,
                                                              monkeypatch):
    folder, rows = str(tmp_path / "out"), spark.sparkContext.accumulator(0)
    lines = raw_lines(*[{"InvoiceNo": f"{'C' if i % 9 == 0 else ''}{i % 50}", "Quantity": i % 7,
                         "UnitPrice": float(i % 5)} for i in range(500)])

    def counted(batches):
        for batch in batches:
            rows.add(len(batch))
            yield batch

    monkeypatch.setattr(job, "load_dataset", lambda *a, **o: lines.mapInPandas(
        counted, lines.schema))
    monkeypatch.setattr(job, "store_forecasts", lambda *a, **o: None)
    job.reload(spark, "", folder)
    assert rows.value == 500
    audit = {r.paso: r.filas for r in read_audit(spark, folder).collect()}
    kept = [r for r in lines.collect() if not r.InvoiceNo.startswith("C")]
    some = [r for r in kept if r.Quantity > 0]
    priced = [r for r in some if r.UnitPrice > 0]
    assert list(audit.values())[:5] == [500, len(kept), len(some), len(priced), len(set(priced))]
    assert read_clean(spark, folder).columns == clean_lines(lines).columns
    assert sorted(map(str, read_clean(spark, folder).collect())) == sorted(
        map(str, clean_lines(lines).collect()))
    for _ in range(3):
        job.reload(spark, "", folder)
    assert len(os.listdir(f"{folder}/_versiones")) == 2


def test_two_jobs_cannot_publish_the_same_number(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    versions.publish(spark, folder, versions.new_version(folder))
    first = current(spark, folder)
    monkeypatch.setattr(versions, "publications", lambda *a: [])
    with pytest.raises(Exception, match="FileAlreadyExists|already exists"):
        versions.publish(spark, folder, versions.new_version(folder))
    monkeypatch.undo()
    assert current(spark, folder) == first and not [
        n for n in os.listdir(f"{folder}/_publicadas") if n.startswith(".") and "crc" not in n]


def test_units_beyond_four_bytes(spark, tmp_path):
    folder = str(tmp_path)
    clear_tables(spark, folder)
    rows = spark.createDataFrame(
        [(None, DAY, 3e9, 3e9 + 0.5, 1.0)],
        "id_producto string, fecha_prediccion date, unidades_predichas double, "
        "unidades_vendidas double, confianza_modelo double")
    append_forecasts(rows, folder)
    stored = read_stored(spark, folder, "predicciones").first()
    assert (stored.unidades_predichas, stored.unidades_vendidas) == (3_000_000_000, 3_000_000_000)


def test_repeated_keys_by_ranges(spark):
    keys = [*range(-5, 70_000, 7), 2, 2, 9, None, None, 2**40]
    df = spark.createDataFrame([(v,) for v in keys], "id bigint")
    known = [v for v in keys if v is not None]
    assert k.repeated_keys(df, "id").first()[0] == len(known) - len(set(known))
    plan = k.repeated_keys(df, "id")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id" not in plan


def test_all_dropped_files_are_one_data_set(spark, tmp_path):
    landing, folder, state = (str(tmp_path / n) for n in ("landing", "out", "state"))
    os.mkdir(landing)
    invoice_file(f"{landing}/z_old.csv", 10, months=2)
    invoice_file(f"{landing}/a_new.csv", 20, months=3)
    with open(f"{landing}/notes.txt", "w") as file:
        file.write("not an invoice file")
    now = time.time()
    os.utime(f"{landing}/z_old.csv", (now - 60, now - 60))

    runs = []

    def tables_only(session, paths, warehouse):
        runs.append([os.path.basename(p) for p in paths])
        raw = job.load_dataset(session, paths)
        job.store_tables(job.store_clean(raw, warehouse), warehouse)

    watch_landing(spark, landing, folder, state, job=tables_only).awaitTermination()
    batch = str(tmp_path / "batch")
    assert runs == [["z_old.csv", "a_new.csv"]]
    tables_only(spark, [f"{landing}/a_new.csv", f"{landing}/z_old.csv"], batch)
    assert units(spark, folder) == units(spark, batch) > 0

    single, state_2 = str(tmp_path / "single"), str(tmp_path / "state_2")
    runs.clear()
    watch_landing(spark, landing, single, state_2, job=tables_only,
                  each_file=True).awaitTermination()
    assert runs == [["z_old.csv"], ["a_new.csv"]]
    tables_only(spark, [f"{landing}/a_new.csv"], batch)
    assert units(spark, single) == units(spark, batch)

    invoice_file(f"{landing}/later.csv", 30, months=2)
    watch_landing(spark, landing, folder, state, job=tables_only).awaitTermination()
    tables_only(spark, [f"{landing}/later.csv"], batch)
    assert units(spark, folder) == units(spark, batch)


def test_arrivals_carry_no_content(spark, tmp_path):
    assert arrivals(spark, str(tmp_path)).columns == ["path", "modificationTime"]


def test_training_many_series(spark, clean_sales):
    rows = [(p, f"{2010 + i // 12}-{i % 12 + 1:02d}-{d:02d}", 5 + i % 4)
            for p in "ab" for i in range(14) for d in (1, 2)]
    rows += [("c", "2010-01-01", 1)]
    training = train(clean_sales(*rows), ["id_producto"], min_days=1)
    assert {r.series_key for r in training.models.collect()} == {"a", "b"}
    assert training.forecast.groupBy(KEY).count().collect()[0]["count"] == 12
    assert [r.series_key for r in training.too_short.collect()] == ["c"]
