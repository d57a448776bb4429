"""slotwise: broadcast-slot, viewer-session and order analytics on Spark DataFrames."""
