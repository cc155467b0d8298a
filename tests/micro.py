"""Nine transactions that hold every case the cleaning has to settle."""

FACT_1 = """\
store_location_key,product_key,collector_key,trans_dt,sales,units,trans_key
1,100,-1,1/5/2015,10.00,1,T2
1,101,7,2015-01-09,20.00,2,T2
2,100,7,2/1/2015,,3,T3
2,102,8,2015-02-10,30.50,,T4
3,100,,1/15/2016,5.00,1,T5
9,100,-1,20150301,40.00,4,T6
4,100,8,2/29/2016,5.00,1,T8
"""
FACT_10 = """\
collector_key,trans_dt,store_location_key,product_key,sales,units,trans_id
0,2015-1-20,1,999,20.00,1,T2
-1,1/2-2015,3,101,7.00,1,T7
"""
LOCATION = """\
store_location_key,province,store_num
1,ON,501
2,ON,502
3,QC,601
4,MB,701
"""
PRODUCT = """\
product_key,category,department
100,Milk,Dairy
101,Bread,Bakery
102,Cheese,Dairy
"""
FILES = {
    "trans_fact_1.csv": FACT_1,
    "trans_fact_10.csv": FACT_10,
    "location.csv": LOCATION,
    "product.csv": PRODUCT,
}


def write(folder):
    for name, text in FILES.items():
        (folder / name).write_text(text)
    return str(folder)


def rows(df, *columns):
    """Result rows as a sorted list of tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in chosen.collect()), key=repr)
