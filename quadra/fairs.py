"""Market fairs of the city: points of the category ``feiras_alimentacao``."""

# FIXED VALUES: name, latitude, longitude.
FAIRS: list[tuple[str, float, float]] = [
    ("Feira Saude (Sexta/Rua Livramento Do)", -22.8971835, -43.1841545),
    ("Feira Caju (Domingo/Rua Gal. Gurjao)", -22.8746831, -43.210112),
    ("Feira Centro (Sábado/Rua Tadeu Kosciusko)", -22.9144389, -43.1883697),
    ("Feira Centro (Quinta/Rua Conde Lages)", -22.2800004, -42.5325303),
    ("Feira Catumbi (Segunda/Rua Emilia Guimaraes)", -22.9163437, -43.1968102),
    ("Feira Rio Comprido (Quarta/Rua Barao De Sertorio)", -22.9220818, -43.2124574),
    ("Feira Rio Comprido (Sábado/Rua Costa Ferraz)", -22.9232167, -43.2056131),
    ("Feira Cidade Nova (Quinta/Praça Cel. Castelo Branco)", -22.9120636, -43.1980436),
    ("Feira Estacio (Quarta/Rua Sampaio Ferraz)", -22.9161369, -43.2067705),
    ("Feira Sao Cristovao (Quinta/Rua Gal Argolo)", -22.8957998, -43.2258396),
    ("Feira Sao Cristovao (Domingo/Rua Gal Bruce)", -22.894897, -43.2217056),
    ("Feira Santa Teresa (Sexta/Rua Terezina)", -22.9209485, -43.1882594),
    ("Feira Gloria (Domingo/Avenida Augusto Severo)", -22.9199515, -43.1752504),
    ("Feira Laranjeiras (Sábado/Rua Prof. Ortiz Monteiro)", -22.9419116, -43.1923443),
    ("Feira Laranjeiras (Sexta/Viaduto Jardel Filho)", -22.9344207, -43.1843685),
    ("Feira Botafogo (Sábado/Rua Paulo Barreto)", -22.9544213, -43.1867694),
    ("Feira Botafogo (Segunda/Rua Vicente De Souza)", -22.9458155, -43.1855854),
    ("Feira Botafogo (Quarta/Praça Nicaragua)", -22.9419604, -43.1771205),
    ("Feira Botafogo (Sexta/Rua Rodrigo De Brito)", -22.9560424, -43.1827788),
    ("Feira Botafogo (Terça/Rua Barao De Macaubas)", -22.949421, -43.1926911),
    ("Feira Humaita (Quarta/Rua Maria Eugenia)", -22.9558999, -43.2030147),
    ("Feira Urca (Domingo/Praça Tenente Gil Guilherme)", -22.9446153, -43.1614452),
    ("Feira Leme (Segunda/Praça Almte Julio De Noronha)", -22.961704, -43.1669042),
    ("Feira Copacabana (Domingo/Praça Serzedelo Correia)", -22.9693857, -43.1835612),
    ("Feira Copacabana (Quinta/Ronald De Carvalho)", -22.9629176, -43.1770235),
    ("Feira Copacabana (Quarta/Praça Edmundo Bittencourt)", -22.9669699, -43.1900479),
    ("Feira Ipanema (Sexta/Praça Nossa Senhora Da Paz)", -22.9835431, -43.2059821),
    ("Feira Ipanema (Terça/Praça Gal Osorio)", -22.9852258, -43.1977884),
    ("Feira Leblon (Quinta/Praça Nossa Senhora Auxiliadora)", -22.9784126, -43.2231894),
    ("Feira Lagoa (Domingo/Avenida Lineu De Paula Machado)", -22.9636249, -43.2136968),
    ("Feira Jardim Botanico (Sábado/Rua Frei Leandro)", -22.9636362, -43.2233457),
    ("Feira Gavea (Sexta/Praça Santos Dumont)", -22.9737813, -43.2264527),
    ("Feira Praca Da Bandeira (Domingo/Rua Vicente Licinio)", -22.9112162, -43.2131983),
    ("Feira Tijuca (Sexta/Rua Garibaldi)", -22.9343332, -43.2450677),
    ("Feira Tijuca (Sexta/Rua Alzira Brandao)", -22.9211509, -43.2248084),
    ("Feira Tijuca (Segunda/Rua Aguiar)", -22.9234916, -43.2210815),
    ("Feira Tijuca (Terça/Rua Gabriela Prado Maia)", -22.9247351, -43.2327165),
    ("Feira Tijuca (Terça/Praça Prof Pinheiro Guimaraes)", -22.9393931, -43.2486884),
    ("Feira Tijuca (Quarta/Rua Visconde De Figueiredo)", -22.9227968, -43.2273209),
    ("Feira Maracana (Quinta/Rua Moraes E Silva)", -22.9134587, -43.2229415),
    ("Feira Maracana (Sábado/Rua Professor Manoel De Abreu)", -22.9121619, -43.2311861),
    ("Feira Vila Isabel (Terça/Rua Jorge Rudge)", -22.9122509, -43.2392765),
    ("Feira Vila Isabel (Quarta/Rua Mendes Tavares)", -22.9185766, -43.2539891),
    ("Feira Andarai (Domingo/Rua Araripe Junior)", -22.9257425, -43.2518965),
    ("Feira Andarai (Quinta/Rua Silva Teles)", -22.9225043, -43.2434238),
    ("Feira Grajau (Sábado/Rua Duquesa De Bragança)", -22.9228154, -43.2552025),
    ("Feira Grajau (Terça/Rua Mearim)", -22.9209485, -43.26296),
    ("Feira Grajau (Sexta/Avenida Julio Furtado)", -22.9201725, -43.2655268),
    ("Feira Bonsucesso (Terça/Rua Mal Foch)", -22.8700853, -43.2565995),
    ("Feira Ramos (Quinta/Rua Senador Mourao Vieira)", -22.8593533, -43.2599924),
    ("Feira Ramos (Sábado/Rua Felisbelo Freire)", -22.8498012, -43.2611275),
    ("Feira Olaria (Sexta/Rua Antonio Rego)", -22.8520635, -43.2692573),
    ("Feira Olaria (Quarta/Rua Firmino Gameleira)", -22.8423974, -43.2628323),
    ("Feira Penha (Domingo/Rua Belisário Pena)", -22.8321644, -43.2746776),
    ("Feira Penha (Quinta/Rua Gal Silveira Sobrinho)", -22.8424947, -43.3063587),
    ("Feira Penha (Domingo/Rua Macapuri)", -22.8391217, -43.2709343),
    ("Feira Penha (Quarta/Rua Jacui)", -22.8381127, -43.2764454),
    ("Feira Penha (Quinta/Estrada Jose Rucas)", -22.8431835, -43.280689),
    ("Feira Braz De Pina (Sábado/Rua Iricume)", -22.8309084, -43.318807),
    ("Feira Vigario Geral (Sábado/Rua Valentim Magalhaes)", -22.8092415, -43.3067852),
    ("Feira Jardim America (Terça/Rua Franz Liszt)", -22.810005, -43.323212),
    ("Feira Maria Da Graca (Terça/Rua Prof Boscoli)", -22.8825029, -43.2638344),
    ("Feira Del Castilho (Domingo/Rua Bispo Lacerda)", -22.8772185, -43.2675496),
    ("Feira Del Castilho (Sábado/Rua Van Gogh)", -22.8829164, -43.2730718),
    ("Feira Inhauma (Domingo/Rua Dona Emilia)", -22.8726994, -43.284236),
    ("Feira Engenho Da Rainha (Sábado/Rua Mario Ferreira)", -22.8707625, -43.2951085),
    ("Feira Rocha (Sábado/Rua Rocha Do)", -22.9954898, -44.3037932),
    ("Feira Riachuelo (Quinta/Rua Vitor Meireles)", -22.9026953, -43.255175),
    ("Feira Riachuelo (Terça/Rua Doutor Manoel Cotrim)", -22.8966552, -43.2570585),
    ("Feira Engenho Novo (Sexta/Rua Manoel Miranda)", -22.9090942, -43.2678381),
    ("Feira Engenho Novo (Segunda/Rua Grao Para)", -22.9123404, -43.270428),
    ("Feira Lins De Vasconcelos (Sexta/Rua Joaquim Meier)", -22.9073268, -43.2810463),
    ("Feira Meier (Terça/Rua Galdino Pimentel)", -22.9029852, -43.2870713),
    ("Feira Meier (Sexta/Rua Vaz De Caminha)", -22.90173, -43.2797093),
    ("Feira Meier (Quarta/Rua Salvador Pires)", -22.8941373, -43.2780846),
    ("Feira Meier (Quinta/Rua Silva Rabelo)", -22.9014139, -43.279754),
    ("Feira Cachambi (Domingo/Rua Basilio De Brito)", -22.8887152, -43.2682514),
    ("Feira Cachambi (Terça/Rua Odorico Mendes)", -22.8888337, -43.2824098),
    ("Feira Engenho De Dentro (Domingo/Rua Afonso Ferreira)", -22.890837, -43.2956915),
    ("Feira Engenho De Dentro (Quarta/Rua Gustavo Riedel)", -22.8984412, -43.2999744),
    ("Feira Engenho De Dentro (Terça/Rua Catulo Cearence)", -22.9026591, -43.2967757),
    ("Feira Encantado (Sábado/Rua Cruz E Souza)", -22.9005968, -43.3064781),
    ("Feira Piedade (Quarta/Rua Antonio Vargas)", -22.8811254, -43.3086846),
    ("Feira Piedade (Terça/Rua Caminho Do Mateus)", -22.8926665, -43.3110001),
    ("Feira Piedade (Sábado/Rua Teresa Cavalcanti)", -22.8926665, -43.3110001),
    ("Feira Pilares (Quarta/Rua Casemiro De Abreu)", -22.881006, -43.297209),
    ("Feira Vila Kosmos (Sábado/Avenida Vicente De Carvalho)", -22.8502645, -43.3086478),
    ("Feira Vicente De Carvalho (Quarta/Rua Cambuci Do Vale)", -22.8530137, -43.3186933),
    ("Feira Vista Alegre (Sexta/Rua Florania)", -22.8308303, -43.3172144),
    ("Feira Vista Alegre (Domingo/Rua Ponta Pora)", -22.8280528, -43.3170224),
    ("Feira Iraja (Domingo/Rua Marques De Queluz)", -22.8434875, -43.3259497),
    ("Feira Iraja (Sexta/Rua Jose Sombra)", -22.8261639, -43.3279215),
    ("Feira Iraja (Quarta/Avenida Tenente Rebelo)", -22.8138284, -43.3315294),
    ("Feira Iraja (Sexta/Rua Lopes Ferreira)", -22.8490996, -43.3354951),
    ("Feira Campinho (Terça/Rua Ana Teles)", -22.8834197, -43.3533075),
    ("Feira Quintino Bocaiuva (Quarta/Rua Eufrasio Correa)", -22.8852974, -43.3200725),
    ("Feira Cavalcanti (Sábado/Rua Laurindo Filho)", -22.8691475, -43.3186826),
    ("Feira Engenheiro Leal (Quarta/Rua Valerio)", -22.8743923, -43.3255315),
    ("Feira Cascadura (Sexta/Rua Caetano Da Silva)", -22.8802361, -43.32049),
    ("Feira Madureira (Quinta/Rua Henrique Braga)", -22.8780951, -43.3475508),
    ("Feira Madureira (Domingo/Rua Operario Sadock De Sa)", -22.871658, -43.3371976),
    ("Feira Vaz Lobo (Terça/Rua Oliveira Figueiredo)", -22.857214, -43.3272147),
    ("Feira Vaz Lobo (Sábado/Rua Jacina)", -22.8540722, -43.3268013),
    ("Feira Rocha Miranda (Segunda/Rua Rubis)", -22.8434562, -43.350433),
    ("Feira Honorio Gurgel (Sábado/Rua Jurubaiba)", -22.853217, -43.3588685),
    ("Feira Oswaldo Cruz (Quarta/Rua Adelaide Badajos)", -22.8694433, -43.3483392),
    ("Feira Bento Ribeiro (Sexta/Rua Teresa Santos)", -22.8618814, -43.3602953),
    ("Feira Bento Ribeiro (Terça/Rua Obidos)", -22.8754292, -43.3582163),
    ("Feira Bento Ribeiro (Quarta/Rua Sapopemba)", -22.8666778, -43.3647368),
    ("Feira Marechal Hermes (Quinta/Rua Jorge Schmidt)", -22.8627709, -43.3705907),
    ("Feira Ribeira (Sábado/Rua Fernandes Da Fonseca)", -22.8248988, -43.1692527),
    ("Feira Cacuia (Domingo/Rua Sargento Joao Lopes)", -22.8112067, -43.1916236),
    ("Feira Freguesia(Ilha) (Quinta/Rua Aruja)", -22.7934201, -43.1740699),
    ("Feira Jardim Guanabara (Sexta/Avenida Francisco Alves)", -22.8164185, -43.2002799),
    ("Feira Taua (Segunda/Rua Prof Hilariao Da Rocha)", -22.7975704, -43.1861671),
    ("Feira Portuguesa (Quinta/Governador)", -22.7955649, -43.2104056),
    ("Feira Guadalupe (Domingo/Rua Bétula)", -22.8414181, -43.3780048),
    ("Feira Guadalupe (Quinta/Rua Loasa)", -22.849104, -43.37927),
    ("Feira Guadalupe (Quinta/Rua Eneas Martins)", -22.8350084, -43.3770502),
    ("Feira Ricardo De Albuquerque (Domingo/Rua Pereira Da Rocha)", -22.8422911, -43.4026091),
    ("Feira Coelho Neto (Domingo/Rua Ouseley)", -22.8277261, -43.3496376),
    ("Feira Coelho Neto (Terça/Praça Prof Virginia Cidade)", -22.8308521, -43.3452741),
    ("Feira Costa Barros (Quarta/Rua Cel Moreira Cesar)", -22.8211841, -43.3791273),
    ("Feira Jacarepagua (Sábado/Largo Do Anil)", -22.9531726, -43.3715825),
    ("Feira Jacarepagua (Terça/Rua Gal Olivio Uzeda)", -22.9531726, -43.3715825),
    ("Feira Jacarepagua (Quarta/Vossio Brigido, Rua Gal.)", -22.9531726, -43.3715825),
    ("Feira Jacarepagua (Domingo/Avenida Eng. Souza Filho)", -22.9774627, -43.3341519),
    ("Feira Gardenia Azul (Sábado/Avenida Das Lagoas)", -22.9583617, -43.3445873),
    ("Feira Cidade De Deus (Domingo/Rua Edgard Cavaleiro)", -22.94803, -43.362903),
    ("Feira Cidade De Deus (Quarta/Rua Moises)", -22.9480908, -43.3592755),
    ("Feira Freguesia(Jacarepagua) (Terça/Rua Araguaia)", -22.9327985, -43.3308987),
    ("Feira Taquara (Quinta/Rua Ariapo)", -22.920712, -43.3732435),
    ("Feira Taquara (Quarta/Rua José Perigault)", -22.9347662, -43.3689929),
    ("Feira Tanque (Quarta/Rua Alexandre Ramos E Coronel Tedim)", -22.9151927, -43.3557471),
    ("Feira Praca Seca (Domingo/Rua Barão)", -22.8985621, -43.3525275),
    ("Feira Vila Valqueire (Quinta/Rua Das Margaridas)", -22.8829699, -43.3648548),
    ("Feira Vila Valqueire (Domingo/Avenida Jambeiro)", -22.8818822, -43.3713474),
    ("Feira Barra Da Tijuca (Domingo/Praça Sao Perpetuo)", -23.0124289, -43.3177439),
    ("Feira Barra Da Tijuca (Quinta/Praça Sao Perpetuo)", -23.0124289, -43.3177439),
    ("Feira Campo Dos Afonsos (Quarta/Rua Olimpio De Castro)", -22.8795186, -43.3803636),
    ("Feira Magalhaes Bastos (Sexta/Rua Abrantes)", -22.8755654, -43.4109812),
    ("Feira Magalhaes Bastos (Terça/Rua Sao Caetano)", -22.8813181, -43.4103913),
    ("Feira Realengo (Quinta/Rua Magoari)", -22.8805567, -43.4377955),
    ("Feira Realengo (Domingo/Rua Mal Modestino)", -22.8721608, -43.4319767),
    ("Feira Realengo (Sábado/Rua Eunapio Deiro)", -22.8821456, -43.4258625),
    ("Feira Realengo (Domingo/Estrada Manuel Nogueira De Sa)", -22.8937209, -43.41906),
    ("Feira Padre Miguel (Sábado/Rua Helianto)", -22.8896216, -43.4453999),
    ("Feira Bangu (Sábado/Praça Iguatama)", -22.8753053, -43.4648805),
    ("Feira Bangu (Domingo/Rua Prof Clemente Ferreira)", -22.8777715, -43.4633271),
    ("Feira Bangu (Quarta/Rua Mal Marciano)", -22.8693531, -43.4534184),
    ("Feira Bangu (Domingo/Rua Cherburgo)", -22.87331, -43.4511241),
    ("Feira Bangu (Quinta/Rua Urucum)", -22.8844758, -43.4770386),
    ("Feira Senador Camara (Domingo/Rua Carnauba)", -22.8696986, -43.4866168),
    ("Feira Campo Grande (Terça/Rua Campo Maior)", -22.9102521, -43.5423541),
    ("Feira Campo Grande (Domingo/Rua Laudelino Vieira De Campos)", -22.9009768, -43.5669418),
    ("Feira Santa Cruz (Terça/Rua Campeiro-Mor)", -22.9137209, -43.6888405),
    ("Feira Sepetiba (Sábado/Rua Floresta)", -22.9767037, -43.7029537),
    ("Feira Mare (Quarta/Rua Roberto Da Silveira)", -22.8505356, -43.2414378),
]
