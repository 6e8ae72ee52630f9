from chronotally.sources.bronze import lines_are_records, read_bronze
from chronotally.sources.files import data_files, has_files, list_files
from chronotally.sources.footers import footer_reader, stored_extremes, stored_rows, stored_rows_by, stored_summary
from chronotally.sources.tables import (
    read_cleaned,
    read_output,
    read_output_or_none,
    schema_of,
    table_status,
    taken_files,
    watch_folder,
)
