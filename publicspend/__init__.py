"""Public-investment analytics on Spark: one wide row per project code, marts, reports."""
