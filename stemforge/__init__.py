"""stemforge: question-bank and text-corpus analytics on PySpark DataFrames."""
