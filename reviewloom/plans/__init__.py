"""The daily run and the documents it leaves behind."""
