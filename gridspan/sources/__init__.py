from gridspan.sources.files import (
    over_long_rows,
    scan_archive_csv,
    scan_capability_xml,
    scan_demand_csv,
    scan_fuel_xml,
    scan_series_csv,
    scan_zonal_csv,
)

__all__ = [
    "over_long_rows", "scan_archive_csv", "scan_capability_xml", "scan_demand_csv",
    "scan_fuel_xml", "scan_series_csv", "scan_zonal_csv",
]
