"""Names shared by the writers and the readers of a stored star."""

FACT_PARTITION = "order_year"
#: Folder of one build's files, below its table or year.
BUILD = "build"
#: The list of source files a version was built from, and which orders each holds.
SOURCE_FILES, LINEAGE = "source_files", "lineage"
