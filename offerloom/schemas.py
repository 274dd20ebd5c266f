"""Explicit schemas; an empty file still has columns."""

OFFER = (
    "id string, name string, brand string, category string, categoryLabel string, price double, imageUrl string, productUrl string, rating double, reviews long, source string,"
    " barcode string, code string, desc string, vegan boolean, crueltyFree boolean, size string"
)
PRICE_ENTRY = "struct<site:string,price:double,url:string,variantCount:int,imageUrl:string>"
SEARCH_PAGE = (
    "product struct<hits:struct<total:struct<value:long>,hits:array<struct<_source:struct<name:string,brand:string,barcode:string,price:double,special_price:double,crm_price:double,"
    "ross_60_price:double,image:string,url_key:string,rating:double,review_count:long>>>>>"
)
DETAIL_PAGE = (
    "product struct<stockStatus:string,prices:struct<discountedPrice:double,normalPrice:double>,imageUrls:array<struct<fileUrl:string>>,attributes:array<struct<key:string,value:string>>>,"
    "reviewAverage double, reviewCount long"
)
ITEM_LIST = "`@type` string, itemListElement array<struct<item:struct<name:string,image:string,url:string,offers:struct<price:double,lowPrice:double>>,name:string,image:string,url:string,offers:struct<price:double,lowPrice:double>>>"
VARIANTS = "name string, hasVariant array<struct<name:string,url:string,image:string,offers:struct<price:double>>>"
PRODUCT_LIST = (
    "components struct<`product-list`:struct<pagination:struct<totalPages:int>,products:array<struct<code:string,name:string,url:string,price:struct<value:double>,picture:struct<url:string>,"
    "averageRating:double,numberOfReviews:long,purchasable:boolean>>>>"
)
