"""Constants and locations.  The names, patterns and numbers here are fixed values of the public data sets."""

from __future__ import annotations

RELEASE = "2026-06-17.0"
FEATURE_BUCKET = "s3a://overturemaps-us-west-2/release"
REGION = "us-west-2"
CELL_RESOLUTION, PARENT_RESOLUTION = 8, 2
SOURCE = "OpenStreetMap"
SERIES_RELEASE, SERIES_YEAR = "R2025A", 2025
#: Identifier of a yearly 1 km raster: country, year, release.
ASSET_PATTERN = r"^([a-z]{3})_pop_(\d{4})_CN_1km_(R\d{4}[A-Z])_UA_v1$"
POPULATION_LABELS = {
    "kontur": {"label": "Kontur Population", "date": "2023-11-01", "url": "https://data.humdata.org/dataset/kontur-population-dataset"},
    "worldpop": {"label": "WorldPop Global 2", "date": f"{SERIES_YEAR}, {SERIES_RELEASE}", "url": "https://www.worldpop.org/"},
}
PLANET = {"lon_min": -180.0, "lon_max": 180.0, "lat_min": -60.0, "lat_max": 84.0, "lon_step": 360.0, "lat_step": 12.0}
MOST_VIEW_KM2 = 40_000


#: The theme and type under which buildings and road segments are kept.
FEATURES = (("buildings", "building"), ("transportation", "segment"))
STAC = "https://api.stac.worldpop.org"


def feature_paths(release: str = RELEASE) -> tuple[str, ...]:
    """Globs of buildings and road segments of one release."""
    return tuple("/".join((FEATURE_BUCKET, release, f"theme={theme}", f"type={kind}", "*.parquet")) for theme, kind in FEATURES)
