"""The catalog: sources and datasets, as frames for joins and as a checked document."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

NOT_DISPATCHABLE = ("held_elsewhere", "queued_no_parser")


class CatalogError(ValueError):
    pass


@dataclass(frozen=True)
class Catalog:
    document: dict

    def source(self, name: str) -> dict:
        if name not in self.document["sources"]:
            raise CatalogError(f"unknown source: {name}")
        return self.document["sources"][name]

    def dataset(self, source: str, name: str) -> dict:
        datasets = self.source(source).get("datasets") or {}
        if name not in datasets:
            raise CatalogError(f"unknown dataset for {source}: {name}")
        return datasets[name]

    def check_request(self, source: str, dataset: str, first: int, last: int) -> dict:
        spec = self.dataset(source, dataset)
        if first > last:
            raise CatalogError(f"first year {first} is after last year {last}")
        if first < spec["first_year"] or last > spec["last_year"]:
            raise CatalogError(f"years {first}-{last} are outside {spec['first_year']}-{spec['last_year']}")
        return spec

    def problems(self) -> list[str]:
        """Datasets that can neither be harvested nor say why not."""
        out = []
        for s, source in self.document["sources"].items():
            for d, spec in (source.get("datasets") or {}).items():
                closed, seeds = spec.get("harvest_disposition"), any(spec.get(k) for k in ("census_seeds", "census_seed_ranges", "seed_inventory"))
                if closed is not None and closed not in NOT_DISPATCHABLE:
                    out.append(f"{s}/{d}: unknown disposition {closed}")
                if closed in NOT_DISPATCHABLE and (seeds or not spec.get("disposition_reason")):
                    out.append(f"{s}/{d}: {closed} needs a reason and no seeds")
                if closed is None and not seeds:
                    out.append(f"{s}/{d}: no seeds and no disposition")
        return out

    def frames(self, spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
        """sources, datasets, dataset_prefixes, seed_ranges. Sizes are those of a hand-written file."""
        src, sets, prefixes, ranges = [], [], [], []
        for s, v in self.document["sources"].items():
            src.append((s, v.get("domains") or [], float(v.get("delay_seconds", 1.0)), v.get("discovery_prefixes") or [], v.get("discovery_probes") or []))
            for d, x in (v.get("datasets") or {}).items():
                sets.append((s, d, x.get("first_year"), x.get("last_year"), x.get("parser_probe"), bool(x.get("multi_table")), x.get("harvest_disposition"), x.get("disposition_reason")))
                prefixes += [(s, d, p, i) for i, p in enumerate(x.get("allowed_prefixes") or [])]
                ranges += [(s, d, r["first_year"], r["last_year"], r["template"]) for r in x.get("census_seed_ranges") or []]
        return (
            spark.createDataFrame(src, "source string, domains array<string>, delay_seconds double, discovery_prefixes array<string>, discovery_probes array<string>"),
            spark.createDataFrame(sets, "source string, dataset string, first_year int, last_year int, parser_probe string, multi_table boolean, harvest_disposition string, disposition_reason string"),
            spark.createDataFrame(prefixes, "source string, dataset string, prefix string, position int"),
            spark.createDataFrame(ranges, "source string, dataset string, first_year int, last_year int, template string"),
        )


def load_catalog(text: str) -> Catalog:
    """From YAML, or JSON where no YAML reader is installed."""
    try:
        import yaml

        document = yaml.safe_load(text)
    except ModuleNotFoundError:
        import json

        document = json.loads(text)
    if not isinstance(document, dict) or not isinstance(document.get("sources"), dict):
        raise CatalogError("a catalog needs a mapping named sources")
    return Catalog(document)
