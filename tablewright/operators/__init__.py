"""The stages of discovery, census, pilot and harvest as DataFrames."""
