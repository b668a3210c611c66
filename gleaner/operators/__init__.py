"""Record-set stages: each turns a DataFrame into kept rows and rejections."""
