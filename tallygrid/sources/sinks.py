"""Writers: canonical JSON, GeoJSON, metadata, manifests, figures and briefs of small results."""

from __future__ import annotations

import hashlib
import json
import os
from html import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def canonical_json(value) -> bytes:
    """Sorted keys, two blanks of indent, one line break at the end."""
    return (json.dumps(value, sort_keys=True, indent=2, ensure_ascii=False) + "\n").encode()


def features(rows: DataFrame, geometry: str = "LineString") -> DataFrame:
    """(segment_id, feature): a GeoJSON feature as text per row; coordinates are [lon, lat] again."""
    line = lambda c: F.transform(c, lambda p: F.array(p["lon"], p["lat"]))
    coords = line(F.col("coords")) if geometry == "LineString" else F.transform("coords", line)
    properties = F.struct(*(F.col(c) for c in rows.columns if c != "coords"))
    shape = F.struct(F.lit(geometry).alias("type"), coords.alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), shape.alias("geometry"), properties.alias("properties"))
    return rows.select(rows.columns[0], F.to_json(feature).alias("feature"))


def _atomic(path: str, data: bytes) -> str:
    with open(path + ".new", "wb") as f:
        f.write(data)
    os.replace(path + ".new", path)
    return hashlib.sha256(data).hexdigest()


def write_geojson(rows: DataFrame, path: str, geometry: str = "LineString", most: int = 1_000_000) -> str:
    """One city's features, in order of their id, as canonical JSON; returns the SHA-256. Fails beyond `most` rows."""
    found = features(rows, geometry).limit(most + 1).collect()
    if len(found) > most:
        raise ValueError("too many features for one file; write partitions with features() instead")
    ordered = [json.loads(r.feature) for r in sorted(found, key=lambda r: str(r[0]))]
    return _atomic(path, canonical_json({"type": "FeatureCollection", "features": ordered}))


def write_metadata(summary: DataFrame, path: str) -> str:
    """A one-row frame as a JSON object."""
    return _atomic(path, canonical_json(json.loads(summary.toJSON().first())))


def manifest(inputs: dict[str, bytes], config: dict, counts: dict[str, int]) -> dict:
    """Hashes of inputs and configuration, and counts of the stages."""
    digest = lambda b: hashlib.sha256(b).hexdigest()
    return {"inputs": {k: digest(v) for k, v in sorted(inputs.items())}, "config": digest(canonical_json(config)), "counts": counts}


def ranked_markdown(top: DataFrame) -> str:
    """A table of (place, segment_id, rate, rate_ci_low, rate_ci_high) rows."""
    lines = ["| # | segment | rate | interval |", "|---|---|---|---|"]
    for r in top.orderBy("place").collect():
        lines.append(f"| {r.place} | {r.segment_id} | {r.rate:.2f} | {r.rate_ci_low:.2f}–{r.rate_ci_high:.2f} |")
    return "\n".join(lines) + "\n"


def bars_svg(top: DataFrame, width: int = 640, row: int = 24) -> str:
    """Bars with interval whiskers for the same rows."""
    rows = top.orderBy("place").collect()
    most = max([r.rate_ci_high for r in rows], default=1.0) or 1.0
    x = lambda v: 160 + (width - 180) * v / most
    out = [f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{row * len(rows) + 8}" role="img">']
    for i, r in enumerate(rows):
        y = i * row + 6
        out.append(f'<text x="4" y="{y + 12}" font-size="12">{escape(str(r.segment_id))}</text>')
        out.append(f'<rect x="160" y="{y}" width="{x(r.rate) - 160:.1f}" height="14" fill="#4878a8"/>')
        out.append(f'<line x1="{x(r.rate_ci_low):.1f}" x2="{x(r.rate_ci_high):.1f}" y1="{y + 7}" y2="{y + 7}" stroke="#222"/>')
    return "\n".join([*out, "</svg>"]) + "\n"


#: Labels of the brief by language.
LABELS = {
    "en": {"title": "Where reports concentrate", "none": "No segment stands out.", "line": "{name}: {rate:.1f} per {per:g} ({low:.1f} to {high:.1f})"},
    "es": {"title": "Dónde se concentran los avisos", "none": "Ningún tramo destaca.", "line": "{name}: {rate:.1f} por {per:g} (de {low:.1f} a {high:.1f})"},
}


def negotiate(header: str, known: tuple[str, ...] = ("en", "es")) -> str:
    """The known language of greatest weight in a list like 'es;q=0.8, en'; the first of equals, else the first known."""
    asked = []
    for i, part in enumerate(header.split(",")):
        tag, *more = [x.strip() for x in part.split(";")]
        try:
            weight = next((float(m[2:]) for m in more if m.startswith("q=")), 1.0)
        except ValueError:
            continue
        if tag.split("-")[0].lower() in known and weight > 0:
            asked.append((-weight, i, tag.split("-")[0].lower()))
    return min(asked)[2] if asked else known[0]


def brief(top: DataFrame, city: str, language: str = "en", per: float = 1000.0) -> str:
    """A short text over significant, published segments."""
    say = LABELS[language]
    rows = top.where("significant and publishable and rate is not null").orderBy(F.desc("rate"), "segment_id").limit(10).collect()
    lines = ["- " + say["line"].format(name=r.name, rate=r.rate, low=r.rate_ci_low, high=r.rate_ci_high, per=per) for r in rows]
    return "\n".join([f"# {say['title']}: {city}", "", *(lines or [say["none"]])]) + "\n"


def dossier(corridors: DataFrame, corridor_id: str) -> str:
    """What may be said of one corridor; without a known exposure there is no rate to tell."""
    r = corridors.where(F.col("corridor_id") == corridor_id).first()
    if r is None:
        raise KeyError(corridor_id)
    rate = "exposure unknown, so no rate" if r.rate is None else f"{r.rate:.2f} per unit ({r.rate_ci_low:.2f} to {r.rate_ci_high:.2f})"
    return f"# {r.name}\n\n{r.n} reports over {len(r.segment_ids)} segments; {rate}.\n"
