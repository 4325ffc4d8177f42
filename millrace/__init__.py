"""millrace: a curation engine for labelled media collections, built on PySpark DataFrames."""
