"""Writing of report tables."""

import re


def write_tables(tables, folder, fmt="parquet"):
    """Write each table of a report into its own folder; returns the path by title."""
    paths = {}
    for title, df in tables.items():
        path = f"{folder.rstrip('/')}/{re.sub(r'[^A-Za-z0-9]+', '_', title).lower()}"
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
            writer.options(header=True, **keep).csv(path)
        else:
            writer.parquet(path)
        paths[title] = path
    return paths
