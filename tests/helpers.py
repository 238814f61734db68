from pathlib import Path

from eclusa.sources.control import CONTROL_FIELDS


def control_row(source, target, **settings):
    row = dict.fromkeys(CONTROL_FIELDS, "")
    row.update(
        dataset_id="d",
        bucket_origem="file://",
        caminho_origem=str(source).lstrip("/"),
        bucket_destino="file://",
        caminho_destino=str(target).lstrip("/"),
        formato_origem="parquet",
        formato_destino="parquet",
        modo_ingestao="overwrite",
    )
    return {**row, **settings}


def data_files(folder, suffix=".parquet"):
    return sorted(p for p in Path(folder).rglob(f"*{suffix}") if not p.name.startswith("."))


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
