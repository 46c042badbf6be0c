"""fluelake: Spark-native operators for collections of records extracted from long documents."""
