"""Weekly shipment-return analytics on Spark DataFrames."""
