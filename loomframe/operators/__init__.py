"""Operators: DataFrame in, DataFrame out, no action unless the text says so."""
