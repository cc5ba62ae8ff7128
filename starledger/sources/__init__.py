from starledger.sources.files import (  # noqa: F401
    load_csv, preview, read_csv, read_if_exists, read_layer, read_year, sql_over,
    write_layer, write_sized, write_csv_years,
)
from starledger.sources.warehouse import conform, publish, refresh_warehouse  # noqa: F401
