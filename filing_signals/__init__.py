"""Filing signals: how strongly companies speak about themes, as Spark jobs over their filings."""
